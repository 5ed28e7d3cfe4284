"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a bounded sample; rules then run in the order
of rejections per unit of cost, and a text leaves the cascade at its first rejection.  Since a
text is kept only if no rule rejects it, the order moves the cost and never the verdict.
"""

from __future__ import annotations

import string
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.llm.common import per_text

SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
SAMPLE_DOCS = 1000
SAMPLE_STEPS = 1 << 40
WINDOW = 8


class TextFacts:
    """What rules look at, each computed at most once and only when asked for."""

    def __init__(self, text: str):
        self.data = text.encode()
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        return len(joined) if joined.isascii() else len(joined.decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        return len(self.data) - len(self.data.translate(None, UPPER))

    @cached_property
    def n_letters(self) -> int:
        return len(self.data) - len(self.data.translate(None, UPPER + LOWER))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.split(None, 1)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside any window of eight words that the text holds twice or more."""
        n = self.n_words
        if n <= WINDOW:
            return 0
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in self.words], dtype=np.int64)
        step, distinct = 1, len(known)
        while step < WINDOW:  # ids of 1, 2, 4 and 8 words: exact, no hashing
            if distinct == len(ids):
                return 0
            _, ids = np.unique(ids[:-step] * len(ids) + ids[step:], return_inverse=True)
            step, distinct = step * 2, int(ids.max()) + 1
        repeated = np.bincount(ids)[ids] > 1
        covered = np.zeros(n + 1, dtype=np.int64)
        starts = np.flatnonzero(repeated)
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + WINDOW, -1)
        return int((np.cumsum(covered[:-1]) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextFacts], bool]


def too_short(facts: TextFacts) -> bool:
    return facts.n_words < 20


def too_repetitive(facts: TextFacts) -> bool:
    return 100 * facts.n_repeat_words > 30 * facts.n_words


def symbol_heavy(facts: TextFacts) -> bool:
    return 2 * facts.n_symbols > facts.n_words


def repeated_lines(facts: TextFacts) -> bool:
    return 100 * facts.n_dup_lines > 30 * len(facts.lines)


def odd_word_length(facts: TextFacts) -> bool:
    return facts.word_chars < 2 * facts.n_words or facts.word_chars > 25 * facts.n_words


def shouting(facts: TextFacts) -> bool:
    return 100 * facts.n_upper > 60 * facts.n_letters


BASE_RULES = (Rule("too_short", too_short), Rule("too_repetitive", too_repetitive))
RULES = (
    *BASE_RULES,
    Rule("symbol_heavy", symbol_heavy),
    Rule("repeated_lines", repeated_lines),
    Rule("odd_word_length", odd_word_length),
    Rule("shouting", shouting),
)


def estimate_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS
) -> list[tuple[str, float, float]]:
    """(name, seconds per text, share rejected) over about ``sample_docs`` texts, chosen by hash.

    The sample is read where it lies; one row per rule reaches the driver. An empty sample counts
    every rule as free and never rejecting.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_STEPS)) < int(np.ceil(share * SAMPLE_STEPS))

    def measure(frames):
        seconds, rejected, seen = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for frame in frames:
            for text in frame["text"]:
                seen += 1
                for rule in rules:
                    facts = TextFacts(text if isinstance(text, str) else "")
                    start = time.perf_counter()
                    rejected[rule] += bool(rule.rejects(facts))
                    seconds[rule] += time.perf_counter() - start
        yield pd.DataFrame(
            [(r.name, seconds[r], float(rejected[r]), seen) for r in rules],
            columns=["name", "seconds", "rejected", "seen"],
        )

    schema = "name string, seconds double, rejected double, seen long"
    sums = (
        docs.where(chosen)
        .select("text")
        .mapInPandas(measure, schema)
        .groupBy("name")
        .agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "seen")])
    )
    found = {r["name"]: r for r in sums.collect() if r["seen"]}
    return [
        (r.name, found[r.name]["seconds"] / found[r.name]["seen"], found[r.name]["rejected"] / found[r.name]["seen"])
        if r.name in found
        else (r.name, 0.0, 0.0)
        for r in rules
    ]


def ordered(rules: Sequence[Rule], estimates: Sequence[tuple[str, float, float]]) -> list[Rule]:
    """Most rejections per second first; rules with equal gain keep their given order."""
    gain = {name: share / max(seconds, 1e-9) for name, seconds, share in estimates}
    return sorted(rules, key=lambda rule: -gain.get(rule.name, 0.0))


def keeps(rules: Sequence[Rule], facts: TextFacts) -> bool:
    return not any(rule.rejects(facts) for rule in rules)


def apply_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, sample_docs: int = SAMPLE_DOCS, kept: str = "kept"
) -> DataFrame:
    """``docs`` with the verdict of the cascade in column ``kept`` (an existing one is replaced).

    Null texts count as empty. Repeated rows each get their verdict.
    """
    cascade = ordered(rules, estimate_rules(docs, rules, sample_docs))
    verdict = per_text(lambda text: (keeps(cascade, TextFacts(text)),), "kept boolean")
    return docs.withColumn(kept, verdict("text")["kept"])


FACTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def rule_report(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: all base figures, the base verdict and the cascade's verdict.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` are computed
    for every text. ``base_failed`` comes from the two base rules; the cascade runs only where they
    pass. Columns of ``docs`` other than ``doc_id`` and ``text`` are ignored; an empty table gives no
    rows; a null text has only zeros and fails.
    """
    cascade = [
        rule
        for rule in ordered(RULES, estimate_rules(docs, RULES, sample_docs))
        if rule not in BASE_RULES
    ]

    def report(text: str) -> tuple:
        f = TextFacts(text)
        failed = not keeps(BASE_RULES, f)
        figures = (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words)
        return (*figures, failed, not failed and keeps(cascade, f))

    return docs.select("doc_id", per_text(report, FACTS)("text").alias("r")).select("doc_id", "r.*")
