"""Ranking metrics, computed on executors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
CUTOFFS = (5, 10, 20)
COVERAGE_K = 10


def rank_recs(recs: DataFrame) -> DataFrame:
    """Number each user's recommendations from 1 by score; items break ties.

    A user has as many rows as were asked for, so the window stays small.
    """
    best_first = Window.partitionBy("user_id_int").orderBy(F.desc("score"), "token_id_int")
    return recs.select(
        "user_id_int", F.row_number().over(best_first).alias("rank"), "token_id_int", "score"
    )


def ground_truth(test: DataFrame) -> DataFrame:
    """The set of held-out items by user, sorted; at most the catalog in length.

    The metrics below work on the rows of ``test`` instead and never build these sets.
    """
    return test.groupBy("user_id_int").agg(
        F.sort_array(F.collect_set("token_id_int")).alias("actual_tokens")
    )


def _per_user(recs: DataFrame, test: DataFrame, ks: Sequence[int]) -> DataFrame:
    # Both sides are stacked and folded by (user, item), then by user. Each fold combines
    # before its shuffle, so a user with a third of all held-out rows stays cheap.
    recommended = recs.select(
        "user_id_int", "token_id_int", F.col("rank").alias("rank"), F.lit(0).alias("held_out")
    )
    held_out = test.select(
        "user_id_int", "token_id_int", F.lit(None).cast("int").alias("rank"), F.lit(1).alias("held_out")
    )
    by_item = (
        recommended.unionByName(held_out)
        .groupBy("user_id_int", "token_id_int")
        .agg(F.min("rank").alias("rank"), F.max("held_out").alias("held_out"))
    )
    hit = F.col("held_out") == 1
    gain = 1.0 / F.log2(F.col("rank") + 1)
    sums = [F.sum("held_out").alias("n_rel"), F.count("rank").alias("n_recs")]
    for k in ks:
        inside = hit & (F.col("rank") <= k)
        sums.append(F.count_if(inside).alias(f"hits_{k}"))
        sums.append(F.coalesce(F.sum(F.when(inside, gain)), F.lit(0.0)).alias(f"dcg_{k}"))
    return by_item.groupBy("user_id_int").agg(*sums).filter(F.col("n_rel") > 0)


def ranking_metrics(recs: DataFrame, test: DataFrame, ks: Sequence[int] = CUTOFFS) -> DataFrame:
    """Mean precision, recall, NDCG and hit rate, one row per cutoff, from one pass.

    The means run over test users that have recommendations (``users_eval``); ``users_total``
    counts all test users. Without any user to evaluate the metrics are 0.
    """
    users = _per_user(recs, test, ks)
    served = F.col("n_recs") > 0
    entries = []
    for k in ks:
        ideal = F.lit([sum(1.0 / math.log2(i + 2) for i in range(n + 1)) for n in range(k)])
        best = F.get(ideal, F.least(F.col("n_rel"), F.lit(k)).cast("int") - 1)
        hits = F.col(f"hits_{k}")

        def mean(value):
            return F.round(F.coalesce(F.avg(F.when(served, value)), F.lit(0.0)), 4)

        entries.append(
            F.struct(
                F.lit(k).alias("k"),
                mean(hits / k).alias("precision"),
                mean(hits / F.col("n_rel")).alias("recall"),
                mean(F.col(f"dcg_{k}") / best).alias("ndcg"),
                mean((hits > 0).cast("double")).alias("hit_rate"),
                F.count_if(served).alias("users_eval"),
                F.count(F.lit(1)).alias("users_total"),
            )
        )
    return users.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def ndcg_at_k(recs: DataFrame, test: DataFrame, k: int = COVERAGE_K) -> DataFrame:
    """One row: mean NDCG at ``k`` and the number of users behind it."""
    return ranking_metrics(recs, test, [k]).select("ndcg", F.col("users_eval").alias("users"))


def catalog_coverage(recs: DataFrame, interactions: DataFrame, k: int = COVERAGE_K) -> DataFrame:
    """One row: distinct items recommended in the top ``k`` against all known items."""
    known = interactions.agg(F.count_distinct("token_id_int")).scalar()
    return (
        recs.filter(F.col("rank") <= k)
        .agg(F.count_distinct("token_id_int").alias("covered"))
        .withColumn("catalog", known)
        .withColumn(
            "coverage_pct",
            F.coalesce(F.try_divide("covered", "catalog") * 100.0, F.lit(0.0)),
        )
    )
