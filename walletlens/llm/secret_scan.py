"""Secret scans with one deterministic automaton for all rules.

The rules' regexes become one nondeterministic automaton, which subset construction and
minimisation turn into a transition array.  A single pass over the bytes runs it for all rules at
once; text is cut into lanes at bytes that lead every state back to the start, so numpy can advance
thousands of lanes by one byte at a time.  A stretch between two such bytes in which the automaton
accepts a rule goes to that rule's own expression, which settles the exact span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from walletlens.llm.common import map_batches

_parser = re._parser


@dataclass(frozen=True)
class SecretRule:
    """``detect`` is what the automaton runs; ``find`` gives the span; ``least`` applies to ``group``.

    Every match of ``find`` with ``least`` characters must contain a match of ``detect``; a short
    ``detect`` keeps the automaton small, since states count the characters of all rules at once.
    """

    kind: str
    detect: str
    find: str
    least: int = 0
    group: int = 0


_ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    SecretRule(
        "assign",
        _ASSIGN + r"[A-Za-z0-9+/_.=-]{2}",
        f"({_ASSIGN})([A-Za-z0-9+/_.=-]+)",
        12,
        2,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{2}", r"AKIA[A-Z0-9]+", 18),
    SecretRule("hex", r"[0-9a-f]{16}", r"[0-9a-f]+", 16),
)
RULES = (
    *BASE_RULES,
    SecretRule("github", r"gh[oprsu]_[A-Za-z0-9]", r"gh[oprsu]_[A-Za-z0-9]+", 24),
    SecretRule("chat", r"xox[abpr]-[A-Za-z0-9-]", r"xox[abpr]-[A-Za-z0-9-]+", 15),
    SecretRule("signed", r"eyJ[A-Za-z0-9_-]{2}", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    SecretRule("private_key", r"-----BEGIN [A-Z]", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class _Nfa:
    """Thompson construction over the parse tree of the standard library's own parser."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def add(self, tree, at: int) -> int:
        for op, arg in tree:
            at = self._node(str(op), arg, at)
        return at

    def _node(self, op: str, arg, at: int) -> int:
        if op in ("LITERAL", "IN", "ANY"):
            end = self.state()
            self.edges[at].append((_byte_set(op, arg), end))
            return end
        if op == "SUBPATTERN":
            return self.add(arg[-1], at)
        if op == "BRANCH":
            end = self.state()
            for branch in arg[1]:
                self.empty[self.add(branch, at)].append(end)
            return end
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            for _ in range(low):
                at = self.add(body, at)
            if high == _parser.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(body, loop)].append(loop)
                return loop
            ends = [at]
            for _ in range(high - low):
                at = self.add(body, at)
                ends.append(at)
            end = self.state()
            for e in ends:
                self.empty[e].append(end)
            return end
        raise ValueError(f"{op} is not supported in a detecting expression")


def _byte_set(op: str, arg) -> frozenset:
    if op == "LITERAL":
        if arg > 127:
            raise ValueError("detecting expressions are ASCII")
        return frozenset((arg,))
    if op == "ANY":
        return frozenset(range(256)) - {10}
    chosen: set[int] = set()
    negated = False
    for kind, value in arg:
        if str(kind) == "NEGATE":
            negated = True
        elif str(kind) == "LITERAL":
            chosen.add(value)
        elif str(kind) == "RANGE":
            chosen.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"{kind} is not supported in a detecting expression")
    return frozenset(range(256)) - chosen if negated else frozenset(chosen)


@dataclass(frozen=True)
class Automaton:
    classes: np.ndarray  # byte -> class
    step: np.ndarray  # state * n_classes + class -> state * n_classes
    n_classes: int
    n_states: int
    found: np.ndarray  # state -> bit mask of the rules it accepts
    resets: np.ndarray  # byte -> True if it leads every state to the start


def compile_rules(patterns: tuple[str, ...]) -> Automaton:
    """Subset construction and minimisation of the union, searched for at every place."""
    nfa = _Nfa()
    start = nfa.state()
    accept: dict[int, int] = {}
    for i, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.empty[start].append(first)
        end = nfa.add(_parser.parse(pattern), first)
        accept[end] = accept.get(end, 0) | 1 << i
    # Bytes that no expression tells apart form one class.
    sets = list({s for edges in nfa.edges for s, _ in edges})
    signature: dict[tuple, int] = {}
    classes = np.array([signature.setdefault(tuple(b in s for s in sets), len(signature)) for b in range(256)])
    sample = {c: b for b, c in reversed(list(enumerate(classes.tolist())))}

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in nfa.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    home = closure([start])
    number, queue, table, masks = {home: 0}, [home], [], []
    for subset in queue:  # grows while it is walked
        masks.append(sum({accept[s] for s in subset if s in accept}) if subset & accept.keys() else 0)
        row = []
        for c in range(len(signature)):
            after = closure({t for s in subset for chosen, t in nfa.edges[s] if sample[c] in chosen} | {start})
            if after not in number:
                number[after] = len(number)
                queue.append(after)
            row.append(number[after])
        table.append(row)
    return _minimised(np.array(table), np.array(masks), classes, len(signature))


def _minimised(table: np.ndarray, masks: np.ndarray, classes: np.ndarray, n_classes: int) -> Automaton:
    """Split states by acceptance, then by where their bytes lead, until nothing splits."""
    _, block = np.unique(masks, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(block, return_index=True)[1]
    order = np.argsort(first)  # the start state gets number 0
    renamed = np.empty_like(order)
    renamed[order] = np.arange(len(order))
    small = renamed[block[table[first[order]]]]
    resets = (small == 0).all(axis=0)[classes]
    return Automaton(
        classes.astype(np.uint8), (small * n_classes).astype(np.int32).ravel(), n_classes, len(small),
        masks[first[order]], resets,
    )


LANE_BYTES = 2048


def _lanes(data: np.ndarray, resets: np.ndarray, lane_bytes: int) -> np.ndarray:
    """Lane borders, 0 and the end included: the first reset byte at or behind each multiple of ``lane_bytes``.

    Where resets are too far apart a lane is cut all the same; the state it begins in is then not known yet.
    """
    cuts = np.flatnonzero(resets[data])
    wanted = np.searchsorted(cuts, np.arange(lane_bytes, len(data), lane_bytes))
    inner = cuts[np.unique(wanted[wanted < len(cuts)])] + 1
    borders = np.unique(np.concatenate([[0], inner, [len(data)]]))
    long = np.flatnonzero(np.diff(borders) > 2 * lane_bytes)
    return np.unique(np.concatenate([borders, *[np.arange(borders[i], borders[i + 1], lane_bytes) for i in long]]))


def _advance(machine: Automaton, symbols, accepting, starts, lengths, state):
    """All lanes from ``state`` to their ends, one byte of each at a time: end states, and hits as (lane, place, mask)."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, state = starts[order], lengths[order], state[order]
    quiet = accepting == 0
    lanes, places, masks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, accepting.dtype)]
    shrink_at = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), side="left")
    for t in range(int(lengths[0])):
        active = int(shrink_at[t])  # lanes longer than t come first
        lane = state[:active]
        np.take(machine.step, lane + symbols[starts[:active] + t], out=lane)
        hit = ~quiet[lane]
        if hit.any():
            lanes.append(order[:active][hit])
            places.append(starts[:active][hit] + t)
            masks.append(accepting[lane[hit]])
    ends = np.empty_like(state)
    ends[order] = state
    return ends, np.concatenate(lanes), np.concatenate(places), np.concatenate(masks)


def scan_bytes(machine: Automaton, data: np.ndarray, lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Places (sorted) and rule masks where the automaton is in an accepting state after that byte.

    Every lane begins in the start state. Where the lane before it ends in another one it was begun wrongly and is run
    again from there, until all agree: a lane is right at the latest when all before it are.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    borders = _lanes(data, machine.resets, lane_bytes)
    starts, lengths = borders[:-1], np.diff(borders)
    symbols, accepting = machine.classes[data], machine.found[:, None].repeat(machine.n_classes, 1).ravel()
    begun = np.zeros(len(starts), np.int32)
    ends, lanes, at, mask = _advance(machine, symbols, accepting, starts, lengths, begun)
    while len(wrong := np.flatnonzero(begun[1:] != ends[:-1]) + 1):
        begun[wrong] = ends[wrong - 1]
        ends[wrong], again, *found = _advance(machine, symbols, accepting, starts[wrong], lengths[wrong], begun[wrong])
        stay = ~np.isin(lanes, wrong)
        lanes = np.concatenate([lanes[stay], wrong[again]])
        at, mask = (np.concatenate([old[stay], new]) for old, new in zip((at, mask), found))
    by_place = np.argsort(at)
    return at[by_place], mask[by_place]


def _spans(rules, compiled, text: bytes, hits, masks, resets) -> list[tuple[int, int, int]]:
    """(start, end, rule number) in bytes, from the stretches around the automaton's hits."""
    found = []
    data = np.frombuffer(text, np.uint8)
    cuts = np.flatnonzero(resets[data])
    left = np.searchsorted(cuts, hits, side="left")
    low = np.where(left > 0, cuts[np.maximum(left - 1, 0)] + 1, 0) if len(cuts) else np.zeros(len(hits), int)
    high = np.where(left < len(cuts), cuts[np.minimum(left, len(cuts) - 1)], len(text)) if len(cuts) else np.full(len(hits), len(text))
    stretches: dict[tuple[int, int], int] = {}
    for a, b, m in zip(low.tolist(), high.tolist(), masks.tolist()):
        stretches[a, b] = stretches.get((a, b), 0) | m
    for (a, b), mask in stretches.items():
        for i, rule in enumerate(rules):
            if mask >> i & 1:
                for match in compiled[i].finditer(text, a, b):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found.append((match.start(), match.end(), i))
    return sorted(found)


def scan_texts(
    texts: Sequence[str | None], rules: Sequence[SecretRule] = RULES, machine: Automaton | None = None
) -> list[list[tuple[str, int, int]]]:
    """For each text its (kind, start, end) in code points, by start and then in the order of the rules."""
    machine = machine or compile_rules(tuple(r.detect for r in rules))
    compiled = [re.compile(r.find.encode()) for r in rules]
    coded = [(t or "").encode() for t in texts]
    # Texts are joined by a byte that resets the automaton, so no match crosses from one to the next.
    data = np.frombuffer(b"\n".join(coded), np.uint8)
    assert machine.resets[10]
    sizes = np.fromiter((len(c) + 1 for c in coded), np.int64, len(coded))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    at, mask = scan_bytes(machine, data)
    owner = np.searchsorted(begins, at, side="right") - 1
    out: list[list[tuple[str, int, int]]] = [[] for _ in coded]
    groups = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else []
    for g, first in enumerate(groups):
        last = groups[g + 1] if g + 1 < len(groups) else len(owner)
        i = int(owner[first])
        text = coded[i]
        spans = _spans(rules, compiled, text, at[first:last] - begins[i], mask[first:last], machine.resets)
        if not text.isascii():
            spans = [(len(text[:a].decode()), len(text[:b].decode()), k) for a, b, k in spans]
        out[i] = [(rules[k].kind, a, b) for a, b, k in spans]
    return out


SCHEMA = "doc_id {id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
ROWS_AT_ONCE = 1000


def secret_report(docs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """doc_id, counts of the three base kinds, digest of the base spans, and all spans, per row.

    Null texts count as empty and have no spans; repeated rows each get a row; columns besides
    ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    rules = tuple(rules)
    base = {r.kind for r in BASE_RULES}
    machine = compile_rules(tuple(r.detect for r in rules))  # its size depends on the rules alone

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part: pa.RecordBatch = batch.slice(start, ROWS_AT_ONCE)
                found = scan_texts(part.column("text").to_pylist(), rules, machine)
                shown = [[f"{k}:{a}:{b}" for k, a, b in spans] for spans in found]
                plain = [",".join(s for s, (k, _, _) in zip(x, y) if k in base) for x, y in zip(shown, found)]
                yield {
                    "doc_id": part.column("doc_id"),
                    **{f"n_{kind}": [sum(k == kind for k, _, _ in x) for x in found] for kind in base},
                    "base_sha256": [hashlib.sha256(p.encode()).hexdigest() for p in plain],
                    "spans": [",".join(x) for x in shown],
                }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, SCHEMA.format(id=kind))
