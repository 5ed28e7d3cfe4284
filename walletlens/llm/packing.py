"""Best-two-fit packing of tokenized documents into sequences of bounded length.

A sequence is filled greedily: the longest piece that still fits, again and again.  Then its smallest piece is
replaced by two unpacked ones if these fill the widened gap more tightly.  All that decides is how many pieces of
each length are left, and there are at most as many lengths as a sequence has tokens.  So the plan is made
from that table of counts over the whole corpus: a filling is repeated as often as filling one by one would repeat
it.  Pieces then find their places by their rank among those of their length, and are never brought together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import scratch_path
from walletlens.llm.common import by_bytes, map_batches
from walletlens.llm.token_output import _byte_letters

SEQUENCE_TOKENS = 2048
END_ID = 0
WORDS_KEPT = 400_000

# Fixed by the byte-level pre-tokenizer, for code points below 0x250: contractions, runs of letters, digits or
# other signs with a space before them, and white space, whose last sign goes to what follows.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class ByteTokenizer:
    """A tokenizers file, with the ids of up to ``WORDS_KEPT`` words kept by one task.

    Texts of code points below 0x250 are split here as the file's pre-tokenizer splits them, and each word goes to
    the file's merge model. Texts with other signs or with special tokens, and files that are not
    plain byte-level ones, go through the whole tokenizer.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        splitter = file["pre_tokenizer"] or {}
        plain = file["normalizer"] is None and file["post_processor"] is None and file["model"]["type"] == "BPE"
        self.by_words = plain and (
            [splitter.get(k) for k in ("type", "add_prefix_space", "use_regex")] == ["ByteLevel", False, True]
        )
        special = [re.escape(t["content"]) for t in file["added_tokens"]]
        self.odd = re.compile("|".join(["[^\x00-ɏ]", *special]))
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin1").translate(self.letters)
        ids = np.array([t.id for t in self.whole.model.tokenize(shown)], "<u4").tobytes()
        if len(self.known) < WORDS_KEPT:
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.by_words or self.odd.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.known.get
        return b"".join([known(w) or self._word(w) for w in SPLIT.findall(text)])


def token_pieces(
    docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids of every document's pieces, with ``part`` and ``nth``.

    A document of more than ``size`` tokens, its end id included, is cut into pieces of ``size``; the first one is
    what is left over. ``nth`` counts the pieces of that length that task number ``part`` made before.
    """

    def run(batches):
        tokenizer = ByteTokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        made = Counter()
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in by_bytes(whole, "text"):
                rows, pieces, starts, lengths, ids, nth = [], [], [], [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    coded = tokenizer.encode(text or "") + end
                    n = len(coded) // 4
                    cuts = [0, *range(n % size or min(n, size), n, size), n]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(row)
                        pieces.append(k)
                        starts.append(a)
                        lengths.append(b - a)
                        ids.append(coded[4 * a : 4 * b])
                        nth.append(made[b - a])
                        made[b - a] += 1
                yield {
                    "doc_id": batch.column("doc_id").take(rows), "piece": pieces, "start": starts, "length": lengths,
                    "ids": ids, "part": [part] * len(rows), "nth": nth,
                }

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length int, ids binary, part int, nth long"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def tighter_pair(once: int, twice: int, room: int, least: int) -> tuple[int, int] | None:
    """Two lengths of largest sum above ``least`` and at most ``room``, the longest first among equal sums.

    Bit L of ``once`` is set if a piece of length L is left, of ``twice`` if two are.
    """
    width = once.bit_length()
    mirrored = int(f"{once:0{width}b}"[::-1], 2) if once else 0  # bit width - 1 - L
    for total in range(min(room, 2 * width), least, -1):
        shift = width - 1 - total
        partners = mirrored >> shift if shift >= 0 else mirrored << -shift
        both = once & partners
        if total % 2 == 0 and not twice >> total // 2 & 1:
            both &= ~(1 << total // 2)
        if both:
            longer = both.bit_length() - 1
            return longer, total - longer
    return None


def plan_sequences(counts: dict[int, int], size: int = SEQUENCE_TOKENS) -> Iterator[tuple[Counter, int]]:
    """Fillings (how many pieces of each length) and how many sequences take each, in the order they are made."""
    left = dict(counts)
    present = sum(1 << length for length, n in left.items() if n)
    while present:
        filling, gap, open_lengths = Counter(), size, present
        while fitting := open_lengths & ((1 << gap + 1) - 1):
            longest = fitting.bit_length() - 1
            filling[longest] = min(left[longest], gap // longest)
            gap -= longest * filling[longest]
            open_lengths &= ~(1 << longest)
        times = min(left[length] // n for length, n in filling.items())
        smallest = min(filling)
        if gap and filling.total() > 1:
            once = twice = 0
            spare = present
            while spare:
                length = spare.bit_length() - 1
                spare &= ~(1 << length)
                free = left[length] - filling[length]
                once |= (free > 0) << length
                twice |= (free > 1) << length
            if pair := tighter_pair(once, twice, gap + smallest, smallest):
                filling[smallest] -= 1
                filling += Counter(pair)  # also drops lengths that count nothing now
                times = min(left[length] // n for length, n in filling.items())
                if n := filling[smallest]:  # the greedy fill takes one more of these before it gives one back
                    times = min(times, (left[smallest] - 1) // n)
                times = max(times, 1)
        for length, n in filling.items():
            left[length] -= n * times
            if not left[length]:
                present &= ~(1 << length)
        yield filling, times


class Places:
    """Where the k-th piece of each length goes: runs of ranks, each laid out in one run of sequences."""

    def __init__(self, plan: Iterator[tuple[Counter, int]]):
        runs: dict[int, list[tuple[int, int, int, int]]] = {}
        taken, sequence = Counter(), 0
        for filling, times in plan:
            offset = 0
            for length, n in sorted(filling.items(), reverse=True):
                runs.setdefault(length, []).append((taken[length], sequence, n, offset))
                taken[length] += n * times
                offset += n * length
            sequence += times
        self.runs = {length: np.array(r, np.int64).T for length, r in runs.items()}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset in it) of pieces by length and rank among those of that length."""
        sequences, offsets = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        order = np.argsort(lengths, kind="stable")
        for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else ():
            length = int(lengths[same[0]])
            first, sequence, n, offset = self.runs[length]
            run = np.searchsorted(first, ranks[same], side="right") - 1
            inside = ranks[same] - first[run]
            sequences[same] = sequence[run] + inside // n[run]
            offsets[same] = offset[run] + inside % n[run] * length
        return sequences, offsets


def placed(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` (a stored table of ``token_pieces``) with sequence_id and offset instead of part and nth.

    The driver sees one count per length, at most ``size`` rows. A task's pieces of one length are numbered
    behind those of earlier tasks, which takes one row per task and length.
    """
    counts = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    places = Places(plan_sequences({r["length"]: r["n"] for r in counts}, size))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        pieces.groupBy("part", "length")
        .agg(F.count("*").alias("n"))
        .select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    ranked = pieces.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    kept = [c for c in pieces.columns if c not in ("part", "nth")]

    def run(batches):
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield {**{c: batch.column(c) for c in kept}, "sequence_id": sequence, "offset": offset}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept)
    return map_batches(ranked.select(*kept, "rank"), run, f"{fields}, sequence_id long, offset long")


def stored_pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "pieces")
    token_pieces(docs, tokenizer_path, size, end_id).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece of every row of ``docs``.

    Each document's ids end with ``end_id``; null texts have nothing else. Repeated rows and null ids are packed
    like any others. Sequences have no gaps and no piece twice. Other columns are ignored; an empty table gives no rows.
    Texts are tokenized once, and their pieces stored; ids are not shuffled to be placed unless they are asked for.
    """
    return placed(stored_pieces(docs, tokenizer_path, size, end_id), size)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, doc_ids and ids (unsigned 32-bit) of every sequence; a group has ``size`` tokens at most."""
    in_order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(in_order.alias("pieces"))
        .select(
            "sequence_id",
            F.col("pieces.doc_id").alias("doc_ids"),
            F.expr("aggregate(pieces, cast('' as binary), (joined, p) -> concat(joined, p.ids))").alias("ids"),
        )
    )


def packing_report(
    docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID
) -> DataFrame:
    """``pack_documents`` with the digest of the stored ids in their place."""
    pieces = stored_pieces(docs, tokenizer_path, size, end_id)
    narrow = pieces.select(
        "doc_id", "piece", "start", F.col("length"), F.crc32("ids").alias("ids_crc32"), "part", "nth"
    )
    return placed(narrow, size).withColumn("length", F.col("length").cast("long"))
