"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages and weighted by TF-IDF; document frequencies come from every
document of the corpus.  A randomised singular value decomposition, whose products with the passage
matrix are Spark jobs over its rows, gives a latent space.  Each document is read in overlapping
windows, projected, and compared by cosine with all passages; a candidate then has to hold the
item's words in order (longest common subsequence) and, unless it is nearly verbatim, those of its
answer, so that reordered or loosely related text stays.

Words are hashed to ``SLOTS`` columns, which bounds every table that is sent to tasks; passages are
compared in blocks of ``BLOCK_PASSAGES``.

The space has a fixed rank, so with many passages it loses some.  Runs of a passage's words, one after
the other over all of it, are therefore also looked up by hash in all documents, by a join; what they
find passes the same checks.  A verbatim copy holds all of a passage's runs, and one with fewer changes
than runs holds at least one.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import broadcast_if_at_most, written
from walletlens.llm.common import bit_filter, bits_on, by_bytes, free_name, map_batches, row_key

SLOTS = 1 << 17
DIMENSIONS = 128
OVERSAMPLED = 16
POWER_ROUNDS = 1
PASSAGE_WORDS = 64
WINDOW_WORDS = 48
STRIDE = 24
COMMON_SHARE = 0.2
LEAST_COSINE = 0.5
LEAST_MASS = 0.5
LEAST_COMMON = 0.7
LEAST_ANSWER = 0.5
NEAR_VERBATIM = 0.9
LEAST_ANSWER_WORDS = 3
BLOCK_PASSAGES = 1024
RUN_WORDS = 5  # 3 in passages of fewer than 10 words; passages of 3 to 5 words are one run
LEAST_RUN = 3
SHARED_RUN = 16
FILTER_BITS = (1 << 20, 1 << 28)
BROADCAST_RUNS = 20_000

# Signs and white space become spaces, A-Z become lower case; other bytes stay.
_PLAIN = bytes(
    (b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b > 127) else 32
    for b in range(256)
)
_SENTENCE = re.compile(r"[.!?\n]+")


def plain_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_PLAIN).split() if text else []


def slot_of(word: bytes) -> int:
    return zlib.crc32(word) % SLOTS


def word_numbers(words) -> np.ndarray:
    """A number for each word; its remainder by ``SLOTS`` is the word's slot."""
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def passages_of(text: str | None) -> list[list[bytes]]:
    """The item whole if it is short, else windows of ``PASSAGE_WORDS`` words at half that distance."""
    words = plain_words(text)
    if len(words) <= PASSAGE_WORDS:
        return [words] if words else []
    half = PASSAGE_WORDS // 2
    return [words[i : i + PASSAGE_WORDS] for i in range(0, len(words) - half, half)]


def answer_of(text: str | None) -> list[bytes]:
    """Words of the item's last sentence that has any."""
    for part in reversed(_SENTENCE.split(text or "")):
        if words := plain_words(part):
            return words
    return []


def _is_leak(common: float, answer: float) -> bool:
    return common >= NEAR_VERBATIM or common >= LEAST_COMMON and answer >= LEAST_ANSWER


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, with one bit per word of ``a``."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if found := places.get(w):
            match = row & found
            row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For each slot the pairs of a document and a word in it, and the number of documents."""

    def count(batches):
        seen, n = np.zeros(SLOTS, np.int64), 0
        for batch in (part for whole in batches for part in by_bytes(whole, "text", 1 << 22)):
            for text in batch.column("text").to_pylist():
                n += 1
                np.add.at(seen, word_numbers(set(plain_words(text))) % SLOTS, 1)
        used = np.flatnonzero(seen)
        yield {"slot": np.append(used, -1), "n": np.append(seen[used], n)}

    rows = map_batches(docs.select("text"), count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table, total = np.zeros(SLOTS, np.int64), 0
    for row in rows.toLocalIterator():  # at most SLOTS + 1 rows
        if row["slot"] < 0:
            total = row["n"]
        else:
            table[row["slot"]] = row["n"]
    return table, total


def word_weights(frequency: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequency: cut to 0 for words in ``COMMON_SHARE`` of all documents or more, and uncut."""
    whole = np.log((1 + n_docs) / (1 + frequency)) + 0.01
    return np.maximum(0.0, whole + np.log(COMMON_SHARE)), whole


def _times_gram(passages: DataFrame, basis: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A^T (A basis) for the matrix A of weighted passages of length 1, summed over Spark's tasks.

    ``columns``: slot -> row of ``basis``, or -1; ``weights``: slot -> weight.
    """

    def run(batches):
        total = np.zeros_like(basis)
        for batch in batches:
            for slots, counts in zip(batch.column("slots").to_pylist(), batch.column("counts").to_pylist()):
                slots = np.frombuffer(slots, np.int64)
                known = columns[slots] >= 0
                at, a = columns[slots][known], np.frombuffer(counts, np.int64)[known] * weights[slots[known]]
                a = a / (np.linalg.norm(a) or 1.0)
                total[at] += a[:, None] * (a @ basis[at])[None, :]
        used = np.flatnonzero(total.any(axis=1))
        yield {"at": used, "row": [total[i].tobytes() for i in used]}

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column("at").to_pylist(), batch.column("row").to_pylist()):
                sums[at] = sums.get(at, 0) + np.frombuffer(row)
        yield {"at": list(sums), "row": [s.tobytes() for s in sums.values()]}

    schema = "at int, row binary"
    merged = map_batches(map_batches(passages, run, schema).repartition("at"), merge, schema)
    out = np.zeros_like(basis)
    for row in merged.toLocalIterator():  # one row per used slot
        out[row["at"]] = np.frombuffer(row["row"])
    return out


def latent_space(
    passages: DataFrame, columns: np.ndarray, weights: np.ndarray, n_columns: int, seed: int = 7
) -> np.ndarray:
    """Right singular vectors (used slots x dimensions) of the passage matrix, by a randomised range finder."""
    rank = min(DIMENSIONS + OVERSAMPLED, n_columns)
    basis = np.random.default_rng(seed).standard_normal((n_columns, rank))
    for _ in range(1 + POWER_ROUNDS):
        basis, _ = np.linalg.qr(_times_gram(passages, basis, columns, weights))
    # basis^T A^T A basis is small: its eigenvectors turn the basis into singular vectors.
    values, vectors = np.linalg.eigh(basis.T @ _times_gram(passages, basis, columns, weights))
    return basis @ vectors[:, np.argsort(-values)[:DIMENSIONS]]


@dataclass(frozen=True)
class LatentIndex:
    """What a task needs to search one block of passages."""

    columns: np.ndarray  # slot -> row of ``words``, or -1
    words: np.ndarray  # row -> latent vector times idf
    directions: np.ndarray  # passage -> latent vector of length 1
    lengths: np.ndarray  # passage -> length of its latent vector
    items: list[tuple[int, list[bytes], list[bytes]]]  # passage -> item id, passage words, answer words or none


def candidates(index: LatentIndex, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, passage, cosine) at or above ``LEAST_COSINE``; ``columns``: row of each word of a text, or -1.

    Window i covers words [i * STRIDE, i * STRIDE + WINDOW_WORDS). A window with less than ``LEAST_MASS``
    of a passage's length is measured as if it had that, lest a stray word count as a match.
    """
    known = np.flatnonzero(columns >= 0)
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    steps, starts = np.unique(known // STRIDE, return_index=True)
    sums = np.add.reduceat(index.words[columns[known]], starts, axis=0)
    # A window is two steps: its own and the next, where that holds known words at all.
    windows = sums.copy()
    follows = np.flatnonzero(np.diff(steps) == 1)
    windows[follows] += sums[follows + 1]
    dots = windows @ index.directions.T
    window, passage = np.nonzero(dots >= LEAST_COSINE * LEAST_MASS * index.lengths)
    length = np.maximum(np.linalg.norm(windows[window], axis=1), LEAST_MASS * index.lengths[passage])
    cosine = dots[window, passage] / np.maximum(length, 1e-30)
    near = (cosine >= LEAST_COSINE) & (index.lengths[passage] > 0)
    window, passage, cosine = window[near], passage[near], cosine[near]
    return steps[window], passage, cosine


def _checked(index: LatentIndex, words: list[bytes], window: int, passage: int) -> tuple[float, float]:
    """Shares of the passage's and of the answer's words that the window and its surroundings hold in order."""
    _, wanted, answer = index.items[passage]
    low = max(0, window * STRIDE - PASSAGE_WORDS)
    return _shares(wanted, answer, words[low : window * STRIDE + WINDOW_WORDS + PASSAGE_WORDS])


def _shares(wanted: list[bytes], answer: list[bytes], near: list[bytes]) -> tuple[float, float]:
    there = set(near)
    if sum(w in there for w in wanted) < LEAST_COMMON * len(wanted):  # bounds the subsequence
        return 0.0, 0.0
    common = common_subsequence(wanted, near) / len(wanted)
    if common < LEAST_COMMON:
        return common, 0.0
    return common, common_subsequence(answer, near) / len(answer) if answer else 1.0


def _search(docs: DataFrame, index: LatentIndex, runs: tuple[list[int], np.ndarray] | None = None) -> DataFrame:
    """Items that a document holds, and with ``runs`` (lengths, bit filter) also its runs that may be a passage's.

    One reading of the texts serves both: rows of runs have ``near``, the words around, and no item.
    """
    names = ("item_id", "cosine", "common_share", "answer_share", "run", "near")

    def places(words: list[bytes], numbers: np.ndarray) -> set[tuple[int, bytes]]:
        found = set()
        for n in runs[0] if runs else ():
            hashes = run_hashes(numbers, n)
            for at in np.flatnonzero(bits_on(runs[1], hashes)).tolist():
                near = words[max(0, at - PASSAGE_WORDS) : at + n + PASSAGE_WORDS]
                found.add((int(hashes[at]), b" ".join(near)))
        return found

    def run(batches):
        for batch in (part for whole in batches for part in by_bytes(whole, "text", 1 << 22)):
            rows, out = [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                words = plain_words(text)
                numbers = word_numbers(words)
                best: dict[int, tuple] = {}
                for window, passage, cosine in zip(*candidates(index, index.columns[numbers % SLOTS])):
                    item = index.items[passage][0]
                    common, answer = _checked(index, words, int(window), int(passage))
                    if _is_leak(common, answer):
                        best[item] = max(best.get(item, (0.0, 0.0, 0.0)), (common, answer, float(cosine)))
                out += [(item, cosine, common, answer, None, None) for item, (common, answer, cosine) in best.items()]
                out += [(None, None, None, None, *place) for place in places(words, numbers)]
                rows += [r] * (len(out) - len(rows))
            yield {
                "doc_id": batch.column("doc_id").take(rows) if rows else [],
                **{name: [row[i] for row in out] for i, name in enumerate(names)},
            }

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long"
    schema = f"{kinds}, cosine double, common_share double, answer_share double, run long, near binary"
    return map_batches(docs.select("doc_id", "text"), run, schema)


def run_length(n_words: int) -> int:
    """Words of each run of a passage, 0 if it is too short for one."""
    return RUN_WORDS if n_words >= 2 * RUN_WORDS else LEAST_RUN if n_words >= 2 * LEAST_RUN else (
        n_words if n_words >= LEAST_RUN else 0
    )


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words; ``words``: a number for each word."""
    places = max(0, len(words) - n + 1)
    hashes = np.full(places, n, np.int64)
    for i in range(n):
        hashes = hashes * np.int64(0x9E3779B97F4A7C1) + words[i : i + places]
    return hashes ^ (hashes >> np.int64(29))


def passage_runs(passages: DataFrame) -> DataFrame:
    """run, item_id, words, answer: the runs by which each passage is looked up.

    A run that more than ``SHARED_RUN`` passages have is left to the passage's others, if it has any.
    """

    def cut(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                words = row["words"].split()
                if n := run_length(len(words)):
                    for h in set(run_hashes(word_numbers(words), n)[::n].tolist()):
                        rows.append((h, n, row["item_id"], row["k"], row["words"], row["answer"]))
            names = ("run", "n", "item_id", "k", "words", "answer")
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    schema = "run long, n int, item_id long, k int, words binary, answer binary"
    runs = map_batches(passages.select("item_id", "k", "words", "answer"), cut, schema)
    shared = runs.groupBy("run").agg(F.count("*").alias("shared"))
    rarest = Window.partitionBy("item_id", "k", "words").orderBy("shared", "run")
    ranked = runs.join(shared, "run").withColumn("rank", F.row_number().over(rarest))
    return ranked.where((F.col("shared") <= SHARED_RUN) | (F.col("rank") == 1)).select(
        "run", "n", "item_id", "words", "answer"
    )


def _run_filter(runs: DataFrame) -> tuple[list[int], np.ndarray]:
    """Lengths of the runs and a bit filter of their hashes."""
    total = runs.count()
    lengths = [r["n"] for r in runs.select("n").distinct().collect()]  # at most RUN_WORDS
    low, high = FILTER_BITS
    return lengths, bit_filter(runs, "run", min(high, max(low, 1 << (1024 * total).bit_length())))


def _look_up(near: DataFrame, runs: DataFrame) -> DataFrame:
    """Documents whose places ``near`` (doc_id, run, near) hold a passage's run and pass the checks; cosine is null."""

    def check(batches):
        for batch in batches:
            rows, item_ids, commons, answers = [], [], [], []
            for r, row in enumerate(batch.select(["item_id", "words", "answer", "near"]).to_pylist()):
                common, answer = _shares(row["words"].split(), row["answer"].split(), row["near"].split())
                if _is_leak(common, answer):
                    rows.append(r)
                    item_ids.append(row["item_id"])
                    commons.append(common)
                    answers.append(answer)
            yield {
                "doc_id": batch.column("doc_id").take(rows) if rows else [], "item_id": item_ids,
                "cosine": [None] * len(rows), "common_share": commons, "answer_share": answers,
            }

    kind = f"doc_id {near.schema['doc_id'].dataType.simpleString()}"
    joined = near.join(broadcast_if_at_most(runs.drop("n"), BROADCAST_RUNS), "run")
    schema = f"{kind}, item_id long, cosine double, common_share double, answer_share double"
    return map_batches(joined.select("doc_id", "near", "item_id", "words", "answer"), check, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, common_share, answer_share for each document that holds a benchmark item.

    All documents are searched whole; cosine is null where only a run of words led to the item. Null or wordless items and texts match nothing; repeated rows of
    either table count once per (doc_id, item_id), with their best match; items need a doc of any id, null
    included. Other columns are ignored; empty tables give no rows.
    """
    frequency, n_docs = document_frequencies(docs)
    cut_weights, whole_weights = word_weights(frequency, n_docs)

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                parts = passages_of(text)
                for k, words in enumerate(parts):
                    slots, counts = np.unique(np.array([slot_of(w) for w in words], np.int64), return_counts=True)
                    answer = answer_of(text) if k == len(parts) - 1 else []
                    # The last sentence stands in for an answer, which one of a few or common words cannot.
                    if sum(cut_weights[slot_of(w)] > 0 for w in set(answer)) < LEAST_ANSWER_WORDS:
                        answer = []
                    rows.append((item, k, b" ".join(words), b" ".join(answer), slots.tobytes(), counts.tobytes()))
            names = ("item_id", "k", "words", "answer", "slots", "counts")
            yield {name: [row[i] for row in rows] for i, name in enumerate(names)}

    schema = "item_id long, k int, words binary, answer binary, slots binary, counts binary"
    passages = written(
        map_batches(benchmark.select(F.col("item_id").cast("long"), "text").distinct(), cut, schema), "passages"
    )

    def used_slots(batches):
        """Slots of rare words; all slots of a passage that has few of them, as one copied widely has."""
        for batch in batches:
            for slots in batch.column("slots").to_pylist():
                slots = np.frombuffer(slots, np.int64)
                rare = cut_weights[slots] > 0
                everywhere = 3 * rare.sum() < len(slots)
                slots = slots if everywhere else slots[rare]
                yield {"slot": slots, "everywhere": np.full(len(slots), everywhere)}

    used = map_batches(passages.select("slots"), used_slots, "slot int, everywhere boolean")
    rows = used.groupBy("slot").agg(F.max("everywhere").alias("everywhere")).orderBy("slot").collect()
    slots = [r["slot"] for r in rows]
    weights = cut_weights.copy()
    widely = [r["slot"] for r in rows if r["everywhere"]]
    weights[widely] = whole_weights[widely]
    columns = np.full(SLOTS, -1, np.int32)
    columns[slots] = np.arange(len(slots))
    if not slots:
        nothing = LatentIndex(columns, *[np.zeros((0, 1), np.float32)] * 2, np.zeros(0), [])
        return _search(docs.limit(0), nothing).drop("run", "near")
    space = latent_space(passages.select("slots", "counts"), columns, weights, len(slots))
    word_vectors = (space * weights[slots][:, None]).astype(np.float32)

    runs, found = written(passage_runs(passages), "runs"), None
    for block in _blocks(passages.select("item_id", "words", "answer").orderBy("item_id", "k")):
        vectors, items = [], []
        for row in block:
            words = bytes(row["words"]).split()
            at = columns[[slot_of(w) for w in words]]
            vectors.append(word_vectors[at[at >= 0]].sum(axis=0))
            items.append((row["item_id"], words, bytes(row["answer"]).split()))
        lengths = np.linalg.norm(vectors, axis=1)
        directions = np.array(vectors) / np.maximum(lengths, 1e-30)[:, None]
        index = LatentIndex(columns, word_vectors, directions, lengths, items)
        if found is None:
            # Stored before runs are checked: no task needs two Python workers, which would keep their memory.
            first = written(_search(docs, index, _run_filter(runs)), "found")
            near = first.where("near is not null").select("doc_id", "run", "near")
            found = first.where("near is null").drop("run", "near").unionByName(_look_up(near, runs))
        else:
            found = found.unionByName(_search(docs, index).drop("run", "near"))
    return found.groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("cosine", "common_share", "answer_share")]
    )


def _blocks(rows: DataFrame):
    """Rows in lists of at most ``BLOCK_PASSAGES``, one list in the driver at a time."""
    block = []
    for row in rows.toLocalIterator():
        block.append(row)
        if len(block) == BLOCK_PASSAGES:
            yield block
            block = []
    if block:
        yield block


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item.

    Rows are told apart by id and text, so a clean row stays where another one with its id, or another one without id,
    goes. Null and empty texts stay, repeated rows go together; further columns stay as they are, whatever their names. Empty tables
    give what they must: no documents, or all of them.
    """
    found = find_leaks(docs.select(row_key().alias("doc_id"), "text"), benchmark)
    key = free_name(docs, "row_key")
    leaks = written(found.select(F.col("doc_id").alias(key)).distinct(), "leaks")
    return docs.withColumn(key, row_key()).join(leaks, key, "left_anti").select(*docs.columns)
