"""Prefix trie, fill-in-middle and packing: against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from walletlens.llm import fill_middle, packing, prefix_trie, queries
from walletlens.llm.common import table

FOLDER = "/root/testdata/sf0.001"
LONG = "".join(f"line {i} of a long text, é and 😀\n" for i in range(20_000))


# Prefix trie ----------------------------------------------------------------------------------------------

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key int, slot int, path string"


def trie_by_hand(rows):
    """Nodes of the trie from plain dictionaries, as contracted for the query."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, name, len(text.encode().split())))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - int(np.fmod(c, 20))
        path = own.get(giver, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, len(path)))
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        yield path
        for p in children[path]:
            yield from below(p)

    out = []
    for path, who in members.items():
        tree = list(below(path))
        ends = ",".join(str(c) for c, n in sorted(who) if n == len(path))
        out.append((
            min(who)[0], len(path), min(members[path[:-1]])[0] if path else None, len(who), len(children[path]),
            sum(not children[p] for p in tree), sum((len(members[p]) - 1) * p[-1][1] for p in tree if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie_rows(spark, rows, **options):
    made = spark.createDataFrame([(*r, "d", 1, 2, "p") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(made, **options).collect()), key=str)


@pytest.mark.parametrize("shard_turns", [5, 60, 10_000])
def test_trie_equals_brute_force_across_shards(spark, shard_turns):
    draw = random.Random(shard_turns)
    rows = []
    for c in [*range(-25, 90), *range(1000, 1060)]:
        same = c % 3 == 0  # a third of all conversations are alike
        for turn in range(4 if same else draw.randint(1, 6)):
            text = f"same words {turn}" if same else draw.choice(["a b", "c", "", None, "d e f"])
            rows.append((c, turn, draw.choice(["user", None]) if not same else "user", text))
    draw.shuffle(rows)
    assert trie_rows(spark, rows, shard_turns=shard_turns) == trie_by_hand(rows)


def test_trie_of_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no conversation"), (3, None, "user", "first"), (3, 0, None, None), (3, 0, "", ""),
        (3, 0, "a", "b"), (3, 0, "ab", ""), (5, 1, "user", "one"), (5, 1, "user", "one"),
        *((40, t, "user", f"turn {t % 7}") for t in range(300)), *((60, t, "user", f"turn {t % 7}") for t in range(301)),
        (80, 0, "user", "w " * 50_000), (81, 0, "user", "w"),
    ]
    assert trie_rows(spark, rows) == trie_by_hand(rows)
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "user", "x")]) == []
    # Conversations without turns of their own beyond what an absent one would give are members of the root alone.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    empty = hashlib.sha256(str(lone).encode()).hexdigest()
    assert trie_rows(spark, [(lone, 0, "user", "x")]) == [(lone, 0, None, 1, 0, 1, 0, empty)]


def test_trie_plan_keeps_texts_out_of_shuffles(spark):
    paths = prefix_trie.turn_paths(table(spark, FOLDER, "conversations"))
    plan = paths._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)


@given(st.lists(st.lists(st.integers(1, 3), max_size=9), min_size=1, max_size=30), st.integers(1, 4))
@settings(max_examples=100, deadline=None)
def test_order_and_shared_turns(paths, width):
    lengths = np.array([len(p) for p in paths])
    numbers = np.array([x for p in paths for x in p], np.int64)
    names = np.arange(len(paths))[::-1].copy()
    order, shared = prefix_trie.ordered_paths(numbers, np.cumsum(lengths) - lengths, lengths, names, width)
    want = sorted(range(len(paths)), key=lambda i: (paths[i], names[i]))
    assert order.tolist() == want
    for k in range(1, len(want)):
        a, b = paths[want[k - 1]], paths[want[k]]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == same


# Fill-in-middle -------------------------------------------------------------------------------------------

TEXTS = [
    (1, None), (2, ""), (3, "\n"), (4, "\n\n"), (5, "no end"), (6, "a\nb\nc"), (7, "é\n😀😀\nü€\n"), (8, "has <P> in it\nb"),
    (9, "<S>"), (10, "x<\nP>\n<\nS>"), (6, "a\nb\nc"), (None, "no id\nhere"), (11, "\x00\r\n \x85\n"), (12, LONG),
    (13, "<M"), (-14, "minus\nfourteen\n"),
]
CLASHING = "doc_id long, text string, n string, form int, output double, draw1 string, piece string, length string, offset int"


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(*t, "n", 1, 0.5, "d", "p", "l", 3) for t in TEXTS], CLASHING).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], CLASHING)


def cut_by_hand(doc_id, text, unit="line", fim=100, spm=50):
    import re

    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = list(text) if unit == "char" else re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= fim:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("options", [{}, {"unit": "char"}, {"fim_percent": 50, "spm_percent": 0}])
def test_fill_in_middle_equals_plain_cuts(texts, options):
    made = fill_middle.fill_in_middle(texts, **options)
    names = {"fim_percent": "fim", "spm_percent": "spm", "unit": "unit"}
    want = [cut_by_hand(*t, **{names[k]: v for k, v in options.items()}) for t in TEXTS]
    assert Counter(tuple(r[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
                   for r in made.collect()) == Counter(want)


def test_fill_in_middle_is_reversible(texts, nothing):
    made = fill_middle.fill_in_middle(texts)
    back = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in TEXTS)
    assert fill_middle.fill_in_middle_report(nothing).collect() == []
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(texts, unit="word")


@given(st.text(alphabet="aé€😀\n", max_size=40))
@settings(max_examples=200, deadline=None)
def test_sparse_index_converts_both_ways(text):
    index = fill_middle.SparseIndex.of(np.frombuffer(text.encode(), np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
    assert (index.to_chars(cuts) == chars).all() and (index.to_bytes(chars) == cuts).all()
    assert len(index.places) == sum(not c.isascii() for c in text)


# Packing --------------------------------------------------------------------------------------------------


def filled_by_hand(counts, size):
    """Sequences one by one, from a plain table of what is left."""
    left, out = Counter(counts), []
    while left := +left:
        held, gap = [], size
        while fitting := [x for x in left if left[x] and x <= gap]:
            held.append(max(fitting))
            left[held[-1]] -= 1
            gap -= held[-1]
        if gap and len(held) > 1:
            least = min(held)
            sums = [(a + b, a, b) for a in left for b in left
                    if a >= b and left[a] and left[b] and (a > b or left[a] > 1) and least < a + b <= gap + least]
            if sums:
                _, a, b = max(sums)
                held.remove(least)
                held += [a, b]
                left[least] += 1
                left[a] -= 1
                left[b] -= 1
        out.append(sorted(held))
    return out


@given(st.dictionaries(st.integers(1, 24), st.integers(0, 25), max_size=24))
@settings(max_examples=150, deadline=None)
def test_plan_equals_filling_one_by_one(counts):
    made = [sorted(f.elements()) for f, n in packing.plan_sequences(counts, 24) for _ in range(n)]
    assert made == filled_by_hand(counts, 24)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.BYTE_TOKENIZER)


def check_packing(rows, coded, size):
    """Pieces hold each document's ids in order, and sequences have no gap."""
    ids = defaultdict(list)
    for doc_id, whole in coded:
        n = len(whole)
        cuts = [0, *range(n % size or min(n, size), n, size), n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            ids[doc_id, k, a, b - a, zlib.crc32(np.array(whole[a:b], "<u4").tobytes())].append(k)
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == Counter({k: len(v) for k, v in ids.items()})
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return sequences


def test_packing_of_awkward_texts(spark, texts, nothing, tokenizer):
    coded = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in TEXTS]
    for size in (2048, 5):
        rows = packing.packing_report(texts, queries.BYTE_TOKENIZER, size).collect()
        sequences = check_packing(rows, coded, size)
        lengths = Counter(r["length"] for r in rows)
        assert len(sequences) == len(filled_by_hand(lengths, size)) if size == 5 else True
    assert packing.packing_report(nothing, queries.BYTE_TOKENIZER).collect() == []


def test_packing_of_the_sample(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    coded = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in docs]
    rows = queries.op13_packing(spark, FOLDER).collect()
    sequences = check_packing(rows, coded, 2048)
    total = sum(len(c) for _, c in coded)
    assert len(sequences) <= 1.02 * total / 2048 + 1


def test_packed_sequences_hold_their_pieces(spark, texts, tokenizer):
    packed = packing.pack_documents(texts, queries.BYTE_TOKENIZER, 64)
    made = {r["sequence_id"]: r for r in packing.packed_sequences(packed).collect()}
    for r in packed.collect():
        at = 4 * r["offset"]
        assert bytes(made[r["sequence_id"]]["ids"])[at : at + 4 * r["length"]] == bytes(r["ids"])
    assert sum(len(r["ids"]) for r in made.values()) == 4 * sum(
        len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in TEXTS
    )


@given(st.text(alphabet=st.sampled_from("ab'st re  \n\t\x0b\x1c\x85\xa0é²½_.!9ŋ") | st.characters(codec="utf-8"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_are_cut_as_the_file_cuts_them(text):
    whole = test_words_are_cut_as_the_file_cuts_them.__dict__.setdefault(
        "tokenizer", packing.ByteTokenizer(queries.BYTE_TOKENIZER)
    )
    for t in (text, text + "<|endoftext|>", "".join(c for c in text if c < "ɐ")):
        assert np.frombuffer(whole.encode(t), "<u4").tolist() == whole.whole.encode(t, add_special_tokens=False).ids
