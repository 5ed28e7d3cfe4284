"""Fill-in-middle transformation with a sparse index of multibyte characters.

A text is cut into prefix, middle and suffix, and the parts are put in an order that lets a model learn to
fill the middle in.  Cuts are made in UTF-8 bytes but counted in code points.  Only characters of several bytes
are recorded, by place and excess bytes; a binary search among them turns byte cuts into code points and back,
and between them the two differ by a constant, so spans of ASCII cost nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletlens.llm.common import by_bytes, map_batches

SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class SparseIndex:
    """Characters of several bytes in a run of UTF-8: first byte of each, and excess bytes up to and with it."""

    places: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> SparseIndex:
        places = np.flatnonzero(data >= 0xC0)
        lead = data[places]
        # A lead byte tells how many follow: one, two from 0xE0, three from 0xF0.
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        return cls(places, np.concatenate([[0], np.cumsum(extra)]))

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; cuts lie between characters."""
        return cuts - self.excess[np.searchsorted(self.places, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.places - self.excess[:-1], cuts)]


def draws(seed: int, doc_id: Column, n: int = 4) -> list[Column]:
    """The first ``n`` groups of eight hex digits of a hash of seed and id, as numbers; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"draw{i + 1}") for i in range(n)]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts in one run, and where each text starts and the last one ends."""
    column = column.fill_null("")
    # Offsets are absolute in the buffer, so a slice of a batch needs no copy.
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def cut_places(data: np.ndarray, borders: np.ndarray, first: np.ndarray, second: np.ndarray, unit: str):
    """(units of each text, byte cut of ``first`` % (n + 1) units, that of ``second`` % (n + 1), index).

    ``unit`` is "line" (a run up to and with a newline, or what is left at the end) or "char" (a code point).
    """
    starts, ends = borders[:-1], borders[1:]
    index = SparseIndex.of(data)
    if unit == "char":
        before = index.to_chars(borders)
        n = np.diff(before)
        return n, *(index.to_bytes(before[:-1] + h % (n + 1)) for h in (first, second)), index
    newlines = np.flatnonzero(data == 10)
    low, high = np.searchsorted(newlines, starts), np.searchsorted(newlines, ends)
    whole = high - low
    filled = ends > starts
    rest = np.zeros(len(starts), bool)
    rest[filled] = data[ends[filled] - 1] != 10
    n = whole + rest
    after = np.concatenate([newlines + 1, [0]])  # the last entry is only looked up where it is not taken

    def place(k: np.ndarray) -> np.ndarray:
        return np.where(k == 0, starts, np.where(k <= whole, after[np.minimum(low + k - 1, len(newlines))], ends))

    return n, *(place(h % (n + 1)) for h in (first, second)), index


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    unit: str = "line",
) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars, output for every row of ``docs``.

    All is drawn from a hash of ``seed`` and doc_id, so reruns agree and rows that share an id are cut at the same
    draws. Null texts count as empty, null ids as an empty id. Empty texts, texts that hold a mark and those
    not drawn stay plain, with null for both counts. Other columns are ignored; an empty table gives no rows.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit: {unit}")
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches):
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                data, borders = _bytes_of(batch.column("text"))
                h1, h2, h3, h4 = (batch.column(f"draw{i}").to_numpy() for i in (1, 2, 3, 4))
                n, a, b, index = cut_places(data, borders, h1, h2, unit)
                low, high = np.minimum(a, b), np.maximum(a, b)
                chars = index.to_chars(np.concatenate([borders[:-1], low, high])).reshape(3, -1)
                raw = data.tobytes()
                forms, outputs = [], []
                for i, (s, p, m, e) in enumerate(zip(*(x.tolist() for x in (borders[:-1], low, high, borders[1:])))):
                    text = raw[s:e]
                    if not text or h3[i] % 100 >= fim_percent or any(mark in text for mark in marks):
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    parts = (marks[0] + raw[s:p], marks[1] + raw[m:e], marks[2] + raw[p:m])
                    spm = h4[i] % 100 < spm_percent
                    forms.append("spm" if spm else "psm")
                    outputs.append(b"".join((parts[1], parts[0], parts[2]) if spm else parts))
                plain = np.array([f == "plain" for f in forms], bool)
                yield {
                    "doc_id": batch.column("doc_id"), "n": n, "form": forms, "output": outputs,
                    "prefix_chars": pa.array(chars[1] - chars[0], mask=plain),
                    "middle_chars": pa.array(chars[2] - chars[1], mask=plain),
                }

    kind = docs.schema["doc_id"].dataType.simpleString()
    drawn = docs.select("doc_id", "text", *draws(seed, F.col("doc_id")))
    return map_batches(
        drawn, run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text behind an output: marks stand only where the transformation put them, so they part it again."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "psm", F.concat(first, third, second))
        .when(form == "spm", F.concat(second, third, first))
        .otherwise(output)
    )


def fill_in_middle_report(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` by lines, with digests of the outputs and of the texts rebuilt from them."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
