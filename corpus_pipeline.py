"""A corpus pipeline: five operators in a row, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` stores each stage as Parquet and hands the stored table to the next.

Columns beside doc_id, text, source and n_chars pass through the stages unchanged, whatever they are called. Rows are told
apart by id and text: rows that share an id, or have none, are judged one by one. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.llm import decontaminate, jaccard_join, mixing, quality_classifier, token_output
from walletlens.llm.common import bit_filter, free_name, maybe_in, row_key, table
from walletlens.llm.queries import TOKENIZER

FILTER_BITS = 1 << 24


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose score is below the classifier's threshold; null texts are scored as empty.

    Repeated rows have equal scores and stay or go together; without labels every document stays.
    """
    model = quality_classifier.fit_quality_model(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "quality_score")
    scored = quality_classifier.score_documents(docs, model, score)
    return scored.where(F.col(score) >= quality_classifier.THRESHOLD).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of least id in each near-duplicate group (null before all ids), and of repeated rows one.

    Rows of equal id are ordered by a hash of their texts. Documents without words are near-duplicates of none: of those
    with equal id and text one stays.
    """
    key, copy = free_name(docs, "row_key"), free_name(docs, "copy_number")
    groups = jaccard_join.near_duplicates(docs.select(row_key().alias("doc_id"), "text"))
    judged = groups.groupBy(F.col("doc_id").alias(key)).agg(
        F.max(F.col("component_id") != F.col("doc_id")).alias("goes"), F.count(F.lit(1)).alias("copies")
    )
    judged = written(judged.where("goes or copies > 1").select(key, "goes"), "judged")
    # Texts that go or have copies are shuffled to their judgement; the others stay where they are.
    touched = maybe_in(bit_filter(judged.select(F.col(key)["text_hash"].alias("hash")), "hash", FILTER_BITS))
    keyed = docs.withColumn(key, row_key())
    stay = keyed.where(~touched(F.col(key)["text_hash"])).select(*docs.columns)
    left = keyed.where(touched(F.col(key)["text_hash"])).join(judged.where("goes").select(key), key, "left_anti")
    # Rows that share an id and a text are copies of each other; one of them stays.
    copies = Window.partitionBy(key).orderBy(F.lit(0))
    left = left.withColumn(copy, F.row_number().over(copies)).where(F.col(copy) == 1).select(*docs.columns)
    return stay.union(left)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item; null and empty texts hold none, repeated rows go together."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut or leave out documents so that sources meet their target weights.

    A null source is a source of its own; documents without words are left out; repeated rows count one by one.
    """
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mix as token blocks and return what is read back, one row per document in order of id (null first).

    A null text has the end id alone; rows of equal id follow by a hash of their texts.
    """
    return token_output.token_report(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", write_tokens),
]

#: A classifier, a latent space and a tokenizer have no SQL; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
