"""Quality classifier: supervised embeddings of words, pairs of words and character n-grams.

A word stands for itself, for its character n-grams and for the word 2-gram it makes with the word before it; each
is hashed to a row of an embedding table.  Few pairs of words recur from text to text, so a pair is hashed
word by word, each word to one of ``WORD_CLASSES`` classes: all pairs of two classes share a row.  A pair counts
``PAIR_WEIGHT`` times, about as much as a word's own rows together.  Nothing else enters: no counts made by hand.
A document is the mean of all its rows, and a softmax over it gives the classes.  Table and output
layer are trained together by stochastic gradient descent in numpy on a bounded sample of labelled
documents (``MAX_TRAIN_DOCS``), which reach the driver compressed and are unpacked one at a time.  Because mean
and output layer are linear, scoring needs one number per hashed feature, which is what executors receive.

Classes, weight and n-grams were chosen on fold 1 of the training folds; the held-out fold had no part in it.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.llm.common import in_fold, map_batches, per_text, words_of

BUCKETS = 1 << 17
WORD_CLASSES = 128
ROWS = BUCKETS + WORD_CLASSES**2
PAIR_WEIGHT = 8
DIMENSION = 10
NGRAMS = (3, 4)
MAX_TRAIN_DOCS = 3000
EPOCHS = 8
LEARNING_RATE = 0.5
THRESHOLD = 0.3
CACHED_WORDS = 300_000


def character_ngrams(word: bytes) -> list[str]:
    bounded = f"<{word.decode()}>"
    return [bounded[i : i + n] for n in NGRAMS for i in range(len(bounded) - n + 1)]


def word_row(word: bytes) -> int:
    return zlib.crc32(word, 1) % BUCKETS


def ngram_row(ngram: str) -> int:
    return zlib.crc32(ngram.encode(), len(ngram)) % BUCKETS


def features(word: bytes) -> list[int]:
    """Hashed rows of the word and of its character n-grams, with borders."""
    return [word_row(word), *map(ngram_row, character_ngrams(word))]


def word_class(word: bytes) -> int:
    return zlib.crc32(word, 2) % WORD_CLASSES


def pair_rows(classes: np.ndarray) -> np.ndarray:
    """Hashed rows of the word 2-grams of a text, given the class of each word."""
    return BUCKETS + classes[:-1] * WORD_CLASSES + classes[1:]


def feature_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a text in order, and how often each counts."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = Counter(words)
    ids, weight = [], []
    for w, n in counts.items():
        f = features(w)
        ids += f
        weight += [n] * len(f)
    classes = {w: word_class(w) for w in counts}
    pairs = pair_rows(np.array([classes[w] for w in words]))
    rows, place = np.unique(np.concatenate([np.array(ids), pairs]), return_inverse=True)
    found = np.bincount(place, weights=np.concatenate([np.array(weight), np.full(len(pairs), PAIR_WEIGHT)]))
    return rows, found.astype(np.int64)


def row_shares(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return rows.astype(np.int32), (counts / counts.sum()).astype(np.float32) if len(rows) else np.zeros(0, np.float32)


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a text and their shares of all its features."""
    return row_shares(*feature_counts(text))


def packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Rows and counts without loss: gaps and counts, high bytes apart from low ones, compressed."""
    numbers = np.concatenate([np.diff(rows, prepend=0), counts]).astype("<i8")
    return zlib.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()
    gaps, counts = np.split(numbers, 2)
    return np.cumsum(gaps), counts


class PackedExamples(Sequence):
    """(rows, shares, class) examples from (packed features, class) pairs; each is unpacked when it is asked for."""

    def __init__(self, pairs: list[tuple[bytes, int]]):
        self.pairs = pairs

    def __len__(self) -> int:
        return len(self.pairs)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray, int]:
        data, label = self.pairs[i]
        return (*row_shares(*unpacked(data)), label)


class NgramGains(dict):
    """Gains of character n-grams, kept since words share them."""

    def __init__(self, gain: list[float]):
        self.gain = gain

    def __missing__(self, ngram: str) -> float:
        self[ngram] = found = self.gain[ngram_row(ngram)]
        return found


class WordSums(dict):
    """Numbers of words; a new word's sum of gains, number of features and class are put down under its number."""

    def __init__(self, gain: list[float]):
        self.gain, self.ngrams = gain, NgramGains(gain)
        self.sums, self.sizes, self.classes = array("d"), array("q"), array("q")

    def __missing__(self, word: bytes) -> int:
        ngrams = character_ngrams(word)
        self.sums.append(sum(map(self.ngrams.__getitem__, ngrams), self.gain[word_row(word)]))
        self.sizes.append(len(ngrams) + 1)
        self.classes.append(word_class(word))
        self[word] = number = len(self)
        return number


@dataclass(frozen=True)
class QualityModel:
    """``gain``: what a feature adds to the logit of class 1 over class 0; ``bias``: without features."""

    gain: np.ndarray
    bias: float

    def scorer(self) -> Callable[[str | None], float]:
        """Score of a text; words and n-grams are kept from text to text until there are twice ``CACHED_WORDS``."""
        gain = self.gain.astype(np.float64)
        single = gain.tolist()
        known = WordSums(single)

        def score(text: str | None) -> float:
            nonlocal known
            words = words_of(text)
            if not words:
                return float(1 / (1 + np.exp(-np.clip(self.bias, -30, 30))))
            if len(known) + len(known.ngrams) > 2 * CACHED_WORDS:
                known = WordSums(single)
            at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            pairs = pair_rows(np.frombuffer(known.classes, np.int64)[at])
            total = np.frombuffer(known.sums)[at].sum() + PAIR_WEIGHT * gain[pairs].sum()
            size = np.frombuffer(known.sizes, np.int64)[at].sum() + PAIR_WEIGHT * len(pairs)
            return float(1 / (1 + np.exp(-np.clip(self.bias + total / size, -30, 30))))

        return score


def train(
    examples: Sequence[tuple[np.ndarray, np.ndarray, int]], seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, output layer and bias, by stochastic gradient descent over (rows, shares, class) examples, one at a time.

    No example gives a score of 0.5 everywhere; examples of one class are learnt as they are.
    """
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (ROWS, DIMENSION)).astype(np.float32)
    output, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, EPOCHS * len(examples)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            rows, shares, label = examples[i]
            rate = LEARNING_RATE * (1 - done / steps)
            done += 1
            hidden = shares @ table[rows] if len(rows) else np.zeros(DIMENSION, np.float32)
            logits = hidden @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # The mean's gradient is spread thin over its rows; scale it back as if each row stood alone.
            if len(rows):
                table[rows] -= (rate * np.sqrt(len(rows)) * shares)[:, None] * back[None, :]
    return table, output, bias


def condensed(table: np.ndarray, output: np.ndarray, bias: np.ndarray) -> QualityModel:
    """The same classifier as one number for each row: softmax over two classes needs only the difference of their logits."""
    return QualityModel(table @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def fit_quality_model(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS, seed: int = 7) -> QualityModel:
    """Fit on at most ``max_docs`` labelled documents outside the held-out fold, chosen by hash of the id.

    Only ``labels.quality`` of those documents is read. Null labels, ids and repeated label rows of one
    document (the least label counts) are no extra examples; of texts that share an id the one of least hash is read.
    No labels give a score of 0.5.
    """
    seen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (in_fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id")
        .limit(max_docs)
    )
    # At most max_docs ids: small enough to send to every task whatever the size of the corpus.
    labelled = docs.select("doc_id", "text").join(F.broadcast(seen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    texts = labelled.groupBy("doc_id", "quality").agg(one)

    def extract(batches):
        for batch in batches:
            yield {
                "doc_id": batch.column("doc_id"),
                "quality": batch.column("quality"),
                "features": [packed(*feature_counts(t)) for t in batch.column("text").to_pylist()],
            }

    kind = docs.schema["doc_id"].dataType.simpleString()
    # Put in order here: a sort in Spark would have every text's features made twice, once to find its ranges.
    rows = map_batches(texts.select("doc_id", "text", "quality"), extract,
                       f"doc_id {kind}, quality int, features binary").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return condensed(*train(PackedExamples([(r["features"], r["quality"]) for r in rows]), seed))


def score_documents(docs: DataFrame, model: QualityModel, score: str = "score") -> DataFrame:
    """``docs`` with the model's score in column ``score`` (an existing one is replaced); null texts count as empty."""
    scorer = None

    def scored(text: str) -> tuple:
        nonlocal scorer
        scorer = scorer or model.scorer()
        return (scorer(text),)

    return docs.withColumn(score, per_text(scored, "score double")("text")["score"])


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; repeated rows each get a row."""
    scored = score_documents(docs.select("doc_id", "text"), fit_quality_model(docs, labels))
    return scored.select(
        "doc_id",
        (in_fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
