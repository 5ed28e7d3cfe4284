"""Interaction features, item indexing and the train/test split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.distinct import distinct_counts
from walletlens.functions.ordering import number_rows

# Fixed values.
TRAIN_SHARE = 0.8
SEED = 42

_HASH_RANGE = 1 << 32


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations as rows ``(col_x, col_y, correlation)`` from one aggregate."""
    pairs = [(x, y) for x in columns for y in columns]
    entries = F.array(
        *[
            F.struct(
                F.lit(x).alias("col_x"),
                F.lit(y).alias("col_y"),
                F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("correlation"),
            )
            for x, y in pairs
        ]
    )
    return df.agg(entries.alias("entries")).select(F.inline("entries"))


def minmax_scale(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Scale a column to [0, 1] by its global range; a constant column becomes 0."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")))
    lo, hi = bounds.scalar()["lo"], bounds.scalar()["hi"]
    scaled = F.when(hi > lo, (F.col(column) - lo) / (hi - lo)).otherwise(F.lit(0.0))
    return df.withColumn(out or column, scaled)


def pagerank_scores(ranks: DataFrame) -> DataFrame:
    """Ranks as ``(user_id, pagerank_score)`` scaled to [0, 1]."""
    return minmax_scale(
        ranks.select(F.col("id").alias("user_id"), F.col("pagerank").alias("pagerank_score")),
        "pagerank_score",
    )


def attach_scores(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """Add ``pagerank_score`` by the raw ``user_id``; wallets without one get 0."""
    return pairs.join(scores, "user_id", "left").withColumn(
        "pagerank_score", F.coalesce("pagerank_score", F.lit(0.0))
    )


def score_coverage(scored: DataFrame) -> DataFrame:
    """One row: wallets, wallets with a positive score and their share in percent."""
    with_score = F.when(F.col("pagerank_score") > 0, F.col("user_id"))
    counts = distinct_counts(scored, {"users": F.col("user_id"), "users_with_score": with_score})
    return counts.drop("_rows").withColumn(
        "coverage_pct",
        F.coalesce(F.try_divide("users_with_score", "users") * 100.0, F.lit(0.0)),
    )


def ultimate_confidence(scored: DataFrame) -> DataFrame:
    """Add the implicit rating: log activity raised by the wallet's standing."""
    return scored.withColumn(
        "ultimate_confidence", F.log1p("total_tx") * (F.lit(1.0) + F.col("pagerank_score"))
    )


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum as typed columns."""
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("stddev"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def frequency_index(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add 0-based int indexes ``{column: output}``, most frequent first, ties by text.

    A missing key gets the index after the last one. The labels are numbered on executors:
    a fitted label list would have to pass through the driver. Runs a job per column.
    """
    for column, out in columns.items():
        counts = (
            df.filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        order = [F.desc("_rows"), F.col(column).cast("string")]
        labels = number_rows(counts, order, "_index", start=0).select(column, "_index")
        n_labels = labels.agg(F.count(F.lit(1))).scalar()
        df = (
            df.join(labels, column, "left")
            .withColumn(out, F.coalesce("_index", n_labels).cast("int"))
            .drop("_index")
        )
    return df


def train_test_split(
    df: DataFrame,
    keys: Sequence[str],
    train_share: float = TRAIN_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Split rows by a hash of their keys.

    The same row falls on the same side whatever the partitioning, so a recomputed
    partition cannot move rows between the two sides.
    """
    digest = F.md5(F.concat_ws("|", *keys, F.lit(str(seed))))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    in_train = place < int(train_share * _HASH_RANGE)
    return df.filter(in_train), df.filter(~in_train)
