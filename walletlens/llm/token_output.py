"""Token ids as byte-aligned variable-length codes with separate control bytes.

Ids are renumbered by falling frequency over the whole corpus, so frequent ids take one byte.  A block
of ids is stored as control bytes (four 2-bit lengths each) apart from the data bytes (1 to 4 per id,
little endian).  Decoding looks each control byte up in a table of four lengths, which gives all
places at once; no loop runs over ids.

A stored table has one row per block: a run of documents in ascending order of doc_id.  Spark's
own writer commits it, so it works on any store and survives lost executors.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from walletlens.functions.shared_storage import scratch_path, written
from walletlens.llm.common import map_batches, stage_store

MAGIC = b"VTOK1\0\0\0"
END_ID = 1
BLOCK_TOKENS = 1 << 17
WORDS_KEPT = 300_000
PIECES_KEPT = 600_000
# Signs that form one piece when in a row; "'" is not among them, as it may start a contraction, nor are
# "<", "|" and ">", which make up special tokens.
TAIL_SIGNS = "!#$%&()*+,-./:;=?@[]^_`{}~"

# Control byte -> its four lengths; the first code sits in the lowest bits.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def encode_ids(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    lengths = 1 + (ids > 0xFF).astype(np.uint8) + (ids > 0xFFFF) + (ids > 0xFFFFFF)
    codes = np.zeros(-(-len(ids) // 4) * 4, np.uint8)
    codes[: len(ids)] = lengths - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    spread = ids.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), spread[np.arange(4) < lengths[:, None]].tobytes()


def decode_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers behind ``encode_ids``."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = raw[starts] if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        if len(longer):
            out[longer] |= raw[starts[longer] + k] << np.uint32(8 * k)
    return out


def pack_block(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """One block: magic, number of documents, of ids and of control bytes, documents' sizes, control, data."""
    control, data = encode_ids(ids)
    head = np.array([len(sizes), len(ids), len(control)], "<u8").tobytes()
    return MAGIC + head + np.asarray(sizes, "<u4").tobytes() + control + data


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of a block; raises ValueError for other bytes."""
    if block[:8] != MAGIC:
        raise ValueError("not a block of token ids")
    n_docs, n_ids, n_control = np.frombuffer(block, "<u8", 3, 8).tolist()
    sizes = np.frombuffer(block, "<u4", n_docs, 32)
    at = 32 + 4 * n_docs
    return decode_ids(block[at : at + n_control], block[at + n_control :], n_ids), sizes


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabets show printable bytes as themselves, the others from code point 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordTokenizer:
    """A tokenizers file, applied word by word with what was already seen kept.

    White space is dropped before words are cut, so a text's ids are those of its words in a row. Words
    of Latin letters with other signs behind them are lower-cased and cut here and go to the file's own
    merge model piece by piece; anything else goes through the whole tokenizer. Both stores are bounded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else piece.encode().decode("latin1").translate(self.letters)
            ids = np.array([t.id for t in self.whole.model.tokenize(shown)], "<u4").tobytes()
            if len(self.pieces) < PIECES_KEPT:
                self.pieces[piece] = ids
        return ids

    def word(self, raw: bytes) -> bytes:
        text = raw.decode()
        core = text.rstrip(TAIL_SIGNS)
        # Precomposed Latin letters: lower case then goes letter by letter, and nothing is recomposed.
        if core.isalpha() and (core.isascii() or max(core) <= "\u00ff"):
            ids = self._piece(core.lower())
            if len(core) < len(text):
                ids += self._piece(text[len(core) :])
        else:
            ids = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) < WORDS_KEPT:
            self.words[raw] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        known = self.words.get
        return b"".join([known(raw) or self.word(raw) for raw in (text.encode().split() if text else ())])


def worker_tokenizer(path: str) -> WordTokenizer:
    """One per worker and stage: tasks of a stage share what they keep, and nothing of it outlives the stage."""
    store = stage_store()
    if path not in store:
        store[path] = WordTokenizer(path)
    return store[path]


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, tie (order among equal ids), n_tokens, ids (control and data bytes, framed)."""

    def run(batches):
        tokenizer = worker_tokenizer(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part: pa.RecordBatch = batch.slice(at, 256)
                ids = [
                    np.frombuffer(tokenizer.encode(t) + end, "<u4") for t in part.column("text").to_pylist()
                ]
                yield {
                    "doc_id": part.column("doc_id"),
                    "tie": part.column("tie"),
                    "n_tokens": [len(x) for x in ids],
                    "ids": [b"".join(_framed(x)) for x in ids],
                }

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return map_batches(keyed, run, f"doc_id {kind}, tie long, n_tokens long, ids binary")


def _framed(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    control, data = encode_ids(ids)
    return len(control).to_bytes(4, "little"), control, data


def _unframed(framed: bytes, n: int) -> np.ndarray:
    end = 4 + int.from_bytes(framed[:4], "little")
    return decode_ids(framed[4:end], framed[end:], n)


def frequency_ranks(tokens: DataFrame) -> np.ndarray:
    """Ids by falling count over all documents, smaller id first on ties: rank -> id.

    Each task sends one count per id it met; the vocabulary bounds the table.
    """

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, n in zip(batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist()):
                found = np.bincount(_unframed(ids, n), minlength=len(total))
                found[: len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield {"id": seen, "n": total[seen]}

    counts = map_batches(tokens.select("ids", "n_tokens"), count, "id long, n long")
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").select("id").collect()
    return np.array([r["id"] for r in rows], np.int64)


def write_token_blocks(
    docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Write ``docs`` as blocks of renumbered ids, in ascending order of doc_id, to the table at ``path``.

    Rows of one doc_id follow each other by a hash of their texts; null ids come first; a null text has
    only the end id. An empty table writes no block. ``path``/ranks holds rank -> id.
    """
    spark = docs.sparkSession
    tokens = written(tokenized(docs, tokenizer_path, end_id), "tokens")
    order = frequency_ranks(tokens)
    ranks = np.zeros(int(order.max()) + 1 if len(order) else 1, np.uint32)
    ranks[order] = np.arange(len(order))
    spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{path}/ranks")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of (doc_id, tie) in order, so partition numbers follow doc_id.
    ranged = tokens.repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    kind = docs.schema["doc_id"].dataType

    def pack(batches):
        ids, sizes, names, held, number, before = [], [], [], 0, 0, 0

        def block():
            nonlocal ids, sizes, names, held, number, before
            joined = np.concatenate(ids)
            row = {
                "number": [number], "before": [before], "doc_ids": pa.array([names]), "n_tokens": [held],
                "block": [pack_block(joined, np.array(sizes))],
            }
            ids, sizes, names, held, number, before = [], [], [], 0, number + 1, before + held
            return row

        for batch in batches:
            for name, n, framed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                ids.append(ranks[_unframed(framed, n)])
                sizes.append(n)
                names.append(name)
                held += n
                if held >= block_tokens:
                    yield block()
        if sizes:
            yield block()

    blocks = map_batches(
        ranged.select("doc_id", "n_tokens", "ids"),
        pack,
        f"number int, before long, doc_ids array<{kind.simpleString()}>, n_tokens long, block binary",
    )
    blocks.withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/blocks")


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the stored blocks."""
    order = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()["ids"], "<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    # A block knows the ids before it in its part; those of earlier parts are added here. Parts are the
    # shuffle partitions of the write, so their table is small whatever the corpus.
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    placed = blocks.join(F.broadcast(parts), "part").withColumn("block_start", F.col("part_start") + F.col("before"))

    def unpack(batches: Iterable[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                ranks, sizes = unpack_block(batch.column("block")[i].as_py())
                ids = order[ranks]
                ends = np.cumsum(sizes, dtype=np.int64)
                yield {
                    "doc_id": batch.column("doc_ids")[i].values,
                    "start": batch.column("block_start")[i].as_py() + ends - sizes,
                    "n_tokens": sizes.astype(np.int64),
                    "ids_crc32": [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())],
                }

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return map_batches(
        placed.select("doc_ids", "block_start", "block"),
        unpack,
        f"doc_id {kind}, start long, n_tokens long, ids_crc32 long",
    )


def token_report(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents to scratch storage and read them back; see ``write_token_blocks`` for edge cases."""
    path = scratch_path(docs.sparkSession, "token-blocks")
    write_token_blocks(docs, tokenizer_path, path, end_id)
    return read_token_blocks(docs.sparkSession, path)
