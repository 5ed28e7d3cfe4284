"""Exact removal of repeated byte strings by suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.  Strings that can
be equal are first brought together: the least hash among the grams of a string (48 bytes first) is its
anchor, and equal strings have the same anchor at the same distance.  Neighbouring strings share their
anchor, so a document is cut into segments, each with the strings of one anchor.

* Equal segments are counted, not compared: all their strings repeat.
* Different segments of one anchor are sorted as suffixes in two stages.  Only suffixes smaller
  than their successor are sorted directly; scanning the buckets in order puts every other suffix
  behind the one it precedes in the text.  Adjacent common prefixes of ``LENGTH`` mark repeats.
* An anchor with more different segments than ``CHUNK`` is cut anew by a longer gram, one segment of a kind
  standing for all.  Its strings fall into more anchors, equal ones into the same; with grams as long as the
  strings a segment is one string, and equal ones have been counted.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.llm.common import bit_filter, by_bytes, map_batches, maybe_in

LENGTH = 400
GRAMS = (48, 224, 356, LENGTH)  # each leaves half of what the one before left, then nothing
CHUNK = 2048
PIECE = 1 << 19
SORTED_AT_ONCE = 40_000
FILTER_BITS = 1 << 24
SEGMENT = "tie long, anchor long, digest long, begin int, stop int"

_BASE = 0x5851F42D4C957F2D
_PLACE_BITS = 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, (1 << _PLACE_BITS) + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), (1 << _PLACE_BITS) + 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes at each place, from one running sum."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    n = len(data) - gram + 1
    h = (sums[gram:] - sums[:-gram]) * _DOWN[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, from running minima of blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, gram: int = GRAMS[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first start, last start) of the runs of ``LENGTH``-byte strings that share an anchor.

    ``data`` has at most 2 ** 20 bytes. The leftmost of equal least grams counts.
    """
    if len(data) < LENGTH:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    hashes = gram_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    keyed = (hashes >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS) | places
    least = sliding_least(keyed, LENGTH - gram + 1)
    at = (least & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return hashes[at[first]], first, np.append(first[1:], len(at)) - 1


def two_stage_order(text: np.ndarray, wanted: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Places in ``wanted`` (a mask) in the order of their first ``LENGTH`` bytes.

    ``smaller`` marks places whose suffix is less than its successor. Each wanted place that is not so
    marked must be followed by a wanted place.
    """
    padded = np.concatenate([text, np.zeros(LENGTH, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, LENGTH)
    direct = np.flatnonzero(wanted & smaller)
    rows = np.ascontiguousarray(windows[direct]).view(f"S{LENGTH}").ravel()
    direct = direct[np.argsort(rows, kind="stable")]
    del rows
    induced = wanted & ~smaller
    before: list[list[np.ndarray]] = [[] for _ in range(256)]
    by_char = np.argsort(text[direct], kind="stable")
    borders = np.searchsorted(text[direct][by_char], np.arange(257))
    out = []

    def induce(found: np.ndarray, c: int) -> np.ndarray:
        """Hand the predecessors of ``found`` to their buckets; those of this bucket are returned."""
        p = found[found > 0] - 1
        p = p[induced[p]]
        chars = text[p]
        order = np.argsort(chars, kind="stable")
        p, chars = p[order], chars[order]
        cuts = np.flatnonzero(np.diff(chars)) + 1
        own = p[:0]
        for part in np.split(p, cuts) if len(p) else ():
            if text[part[0]] == c:
                own = part
            else:
                before[text[part[0]]].append(part)
        return own

    for c in range(256):
        level = np.concatenate(before[c]) if before[c] else direct[:0]
        while len(level):
            out.append(level)
            level = induce(level, c)
        own = direct[by_char[borders[c] : borders[c + 1]]]
        if len(own):
            out.append(own)
            induce(own, c)
    return np.concatenate(out) if out else direct[:0]


def adjacent_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix, up to ``LENGTH``, of each place with the one before it in ``order``; 0 for the first."""
    windows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 8192):
        here = order[at : at + 8192]
        differ = windows[here] != windows[order[at - 1 : at - 1 + len(here)]]
        out[at : at + len(here)] = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    return out


def string_classes(segments: list[bytes]) -> list[np.ndarray]:
    """For each segment the class of each of its ``LENGTH``-byte strings; equal strings have equal classes."""
    text = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    real = np.zeros(len(text), bool)
    for s, e in zip(starts.tolist(), ends.tolist()):
        real[s : e - LENGTH + 1] = True
    # A suffix is smaller than its successor if the next unequal pair of neighbours rises; what has no
    # such pair before the end of its segment is sorted directly as well.
    step = np.diff(text.astype(np.int16), append=text[-1:].astype(np.int16))
    step[ends - 1] = 1
    turning = np.flatnonzero(step)
    rising = step[turning[np.searchsorted(turning, np.arange(len(text)))]] > 0
    # A last string that is greater than its successor needs the places up to the next direct one.
    wanted = real.copy()
    for e in ends.tolist():
        p = e - LENGTH
        while not rising[p]:
            p += 1
            wanted[p] = True
    order = two_stage_order(text, wanted, rising)
    order = order[real[order]]
    new = adjacent_prefixes(text, order) < LENGTH
    classes = np.empty(len(text), np.int64)
    classes[order] = np.cumsum(new)
    return [classes[s : e - LENGTH + 1] for s, e in zip(starts.tolist(), ends.tolist())]


def _pieces(texts: list[bytes]):
    """Batches of (row, offset, bytes) that hold every string of every text once; at most 2 ** 20 bytes a batch."""
    batch, held = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            piece = text[offset : offset + PIECE + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if held + len(piece) > 1 << _PLACE_BITS:
                yield batch
                batch, held = [], 0
            batch.append((row, offset, piece))
            held += len(piece)
    if batch:
        yield batch


def _segment_rows(texts: list[bytes], gram: int = GRAMS[0]):
    """(row, anchor, segment hash, start, end) of all segments, as columns."""
    rows, names, digests, begins, stops = [], [], [], [], []
    for batch in _pieces(texts):
        joined = b"".join(p for _, _, p in batch)
        sizes = np.array([len(p) for _, _, p in batch])
        ends = np.cumsum(sizes)
        hashes, first, last = anchors(np.frombuffer(joined, np.uint8), gram)
        # Runs are cut where a text ends; strings that reach into the next text are none.
        for k, (row, offset, _) in enumerate(batch):
            low, high = int(ends[k] - sizes[k]), int(ends[k]) - LENGTH
            i, j = np.searchsorted(last, low), np.searchsorted(first, high, side="right")
            a, b = np.maximum(first[i:j], low), np.minimum(last[i:j], high)
            names.append(hashes[i:j])
            digests += [xxhash.xxh3_64_intdigest(joined[x : y + LENGTH]) for x, y in zip(a.tolist(), b.tolist())]
            rows.append(np.full(len(a), row))
            begins.append(a - low + offset)
            stops.append(b - low + offset + LENGTH)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return (
        join(rows, np.int64), join(names, np.uint64).view(np.int64),
        np.array(digests, np.uint64).view(np.int64), join(begins, np.int64), join(stops, np.int64),
    )


def _coded(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch.column("text").to_pylist()]


def _segments(docs: DataFrame, kind: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, anchor, digest, begin, stop = _segment_rows(_coded(part))
                yield {
                    "doc_id": part.column("doc_id").take(pa.array(row)), "tie": part.column("tie").take(pa.array(row)),
                    "anchor": anchor, "digest": digest, "begin": begin, "stop": stop,
                }

    return map_batches(docs, run, f"doc_id {kind}, {SEGMENT}")


def _cut_anew(pieces: DataFrame, kind: str, gram: int) -> DataFrame:
    """Segments, by grams of ``gram`` bytes, of the strings in ``pieces`` (doc_id, tie, begin, data)."""

    def run(batches):
        for batch in (part for whole in batches for part in by_bytes(whole, "data")):
            row, anchor, digest, begin, stop = _segment_rows(batch.column("data").to_pylist(), gram)
            base = batch.column("begin").to_numpy()[row]
            yield {
                "doc_id": batch.column("doc_id").take(pa.array(row)), "tie": batch.column("tie").take(pa.array(row)),
                "anchor": anchor, "digest": digest, "begin": begin + base, "stop": stop + base,
            }

    return map_batches(pieces.select("doc_id", "tie", "begin", "data"), run, f"doc_id {kind}, {SEGMENT}")


def _sorted_groups(rows: DataFrame, kind: str) -> DataFrame:
    """doc_id, tie, begin, stop of what strings cover that repeat among the ``rows`` (doc_id, tie, anchor, begin, data) of an anchor."""

    def run(batches):
        held, n = [], 0

        def flush():
            nonlocal held, n
            classes = string_classes([data for *_, data in held])
            counts = np.bincount(np.concatenate(classes))
            out = {k: [] for k in ("doc_id", "tie", "begin", "stop")}
            for (doc_id, tie, begin, _), found in zip(held, classes):
                twice = counts[found] > 1
                edges = np.flatnonzero(np.diff(twice.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                for a, b in edges.tolist():
                    for k, v in zip(out, (doc_id, tie, begin + a, begin + b - 1 + LENGTH)):
                        out[k].append(v)
            held, n = [], 0
            return out

        anchor = None
        columns = ("anchor", "doc_id", "tie", "begin", "data")
        for batch in batches:
            for name, *row in zip(*(batch.column(c).to_pylist() for c in columns)):
                # Anchors share a sort (no string has two), but none is cut in two.
                if n >= SORTED_AT_ONCE and name != anchor:
                    yield flush()
                anchor = name
                held.append(row)
                n += len(row[-1]) - LENGTH + 1
        if held:
            yield flush()

    ready = rows.repartition("anchor").sortWithinPartitions("anchor")
    return map_batches(ready, run, f"doc_id {kind}, tie long, begin int, stop int")


def _bytes_of(docs: DataFrame, wanted: DataFrame, kind: str) -> DataFrame:
    """``wanted`` (doc_id, tie, begin, stop, anchor) as doc_id, tie, begin, anchor, data; only texts that hold one are shuffled."""
    wanted = written(
        wanted.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("begin", "stop", "anchor")).alias("cuts")), "cuts"
    )
    holding = maybe_in(bit_filter(wanted, "tie", FILTER_BITS))
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tie") == F.col("w.tie"))
    read = docs.where(holding("tie")).alias("d").join(wanted.alias("w"), same).select("d.doc_id", "d.tie", "text", "cuts")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, cuts, data = [], [], []
                for i, (text, found) in enumerate(zip(_coded(part), part.column("cuts").to_pylist())):
                    rows += [i] * len(found)
                    cuts += found
                    data += [text[c["begin"] : c["stop"]] for c in found]
                yield {
                    "doc_id": part.column("doc_id").take(pa.array(rows, pa.int64())),
                    "tie": part.column("tie").take(pa.array(rows, pa.int64())),
                    **{k: [c[k] for c in cuts] for k in ("begin", "anchor")}, "data": data,
                }

    return map_batches(read, cut, f"doc_id {kind}, tie long, begin int, anchor long, data binary")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tie, begin, stop: stretches of bytes that repeated strings cover; they may overlap.

    ``docs``: doc_id, tie (hash of the text), text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    segments, spans = written(_segments(docs, kind), "segments"), []
    for longer in (*GRAMS[1:], None):
        kinds = segments.groupBy("anchor", "digest").agg(
            F.count("*").alias("copies"), F.min(F.struct("doc_id", "tie", "begin", "stop")).alias("one")
        )
        kinds = written(kinds, "kinds")
        copied = kinds.where("copies > 1").select("anchor", "digest")
        spans.append(segments.join(copied, ["anchor", "digest"]).select("doc_id", "tie", "begin", "stop"))
        # Anchors with different segments: one of each kind is compared with the others, or cut anew if there are many.
        mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
        few = F.col("kinds") <= CHUNK if longer else F.lit(True)
        ones = lambda chosen: kinds.join(mixed.where(chosen), "anchor").select("one.*", "anchor")  # noqa: E731, B023
        spans.append(written(_sorted_groups(_bytes_of(docs, ones(few), kind), kind), "sorted"))
        if not longer or not mixed.where(~few).limit(1).count():
            break
        many = written(_bytes_of(docs, ones(~few), kind), "many")
        segments = written(_cut_anew(many, kind, longer), "segments")
    return reduce(DataFrame.union, spans)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes that stay) for every row of ``docs``.

    Null texts count as empty; texts shorter than ``LENGTH`` bytes stay whole. Repeated rows are copies of
    each other, so their long texts go entirely. Columns besides ``doc_id`` and ``text`` are ignored; an
    empty table gives no rows. ``kept`` may cut a character in two, as strings are compared as bytes.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    spans = repeated_spans(keyed)
    spans = written(
        spans.groupBy("doc_id", "tie").agg(F.collect_set(F.struct("begin", "stop")).alias("spans")), "spans"
    )
    # Texts without a repeat stay where they are; the others are shuffled to their spans.
    touched = maybe_in(bit_filter(spans, "tie", FILTER_BITS))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.tie") == F.col("s.tie"))
    joined = (
        keyed.where(touched("tie")).alias("d").join(spans.alias("s"), same, "left").select("d.doc_id", "text", "spans")
    ).unionByName(
        keyed.where(~touched("tie")).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n_bytes, n_removed, n_spans, kept = [], [], [], []
                for text, found in zip(_coded(part), part.column("spans").to_pylist()):
                    gone = merged([(s["begin"], s["stop"]) for s in found or ()])
                    edges = [0, *(x for span in gone for x in span), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                    n_bytes.append(len(text))
                    n_removed.append(len(text) - len(kept[-1]))
                    n_spans.append(len(gone))
                yield {"doc_id": part.column("doc_id"), "n_bytes": n_bytes, "n_removed": n_removed,
                       "n_spans": n_spans, "kept": kept}

    return map_batches(joined, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def removal_report(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` with the digest of the kept bytes in their place."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

