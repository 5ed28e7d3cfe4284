"""Joins on a key that holds a third of all rows are split at run time."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.operators import features, graph, matrix, portfolio

ROWS = 200_000
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds low enough for the adaptive split to act on test data."""
    old = {key: spark.conf.get(key) for key in SMALL_SKEW}
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def a_third_is_hot(seed):
    return (
        F.when(F.hash("id", F.lit(seed)) % 3 == 0, F.lit(0))
        .otherwise(F.abs(F.hash("id", F.lit(seed + 100)) % 5000))
        .cast("string")
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_transfer_lookup(spark, small_skew):
    transfers = written(
        spark.range(0, ROWS, 1, 8).select(
            a_third_is_hot(1).alias("from_address"),
            a_third_is_hot(2).alias("to_address"),
            a_third_is_hot(3).alias("token_address"),
            F.rand(1).alias("adjusted_value"),
        )
    )
    users = matrix.dense_ids(matrix.wallet_universe(transfers), "user_address", "user_id")
    tokens = matrix.dense_ids(transfers, "token_address", "token_id")
    got = matrix.index_transfers(transfers, users, tokens)
    assert final_plan(got).count("skew=true") == 3
    assert matrix.unmapped_count(got).first() == (ROWS, 0)
    assert got.agg(F.count_distinct("from_user_id")).first()[0] == transfers.select("from_address").distinct().count()


def test_pair_joins(spark, small_skew):
    held = written(
        spark.range(0, ROWS, 1, 8).select(
            a_third_is_hot(1).alias("user_address"),
            F.md5(F.col("id").cast("string")).alias("token_address"),
            F.lit(2).cast("long").alias("tx_count"),
        )
    )
    scored = matrix.score_pairs(held)
    assert "skew=true" in final_plan(scored)
    hot = held.filter("user_address = '0'").count()
    assert hot > ROWS / 4
    assert scored.filter("user_address = '0'").select("total_tx").distinct().collect() == [(2 * hot,)]

    users = written(portfolio.wallet_totals(held))
    kept = portfolio.real_portfolios(held, users)
    assert "skew=true" in final_plan(kept)
    assert kept.count() == ROWS

    pairs = held.withColumnRenamed("user_address", "user_id")
    scores = written(users.select(F.col("user_address").alias("user_id"), F.rand(2).alias("pagerank_score")))
    attached = features.attach_scores(pairs, scores)
    assert "skew=true" in final_plan(attached)
    assert attached.count() == ROWS


def test_pagerank_hub_threshold_follows_the_partitions(spark):
    # Half of all edges leave one wallet: it is served by its broadcast rank.
    edges = spark.range(1, 40001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    edges = edges.unionByName(
        spark.range(1, 40001).select(F.col("id").alias("src"), (F.col("id") % 4000).alias("dst"))
    ).filter("src != dst")
    with_hub = dict(graph.pagerank(edges, iterations=3).collect())
    without = dict(graph.pagerank(edges, iterations=3, min_hub_degree=10**9).collect())
    assert with_hub == pytest.approx(without)
