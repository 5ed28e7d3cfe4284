from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from walletlens import session
from walletlens.operators import evaluate, matrix, recommend
from walletlens.plans.ingest import ingest_slice
from walletlens.plans.queries import popularity_recs
from walletlens.plans.sample_views import SampleViews
from walletlens.sources.tables import read_slices

FOLDER = "/root/testdata/sf0.001"


def test_tune_keeps_a_chosen_broadcast_limit(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        assert session.tune(spark).conf.get(key) == "-1"
        spark.conf.unset(key)
        assert session.tune(spark).conf.get(key) == session.BROADCAST_LIMIT
    finally:
        spark.conf.set(key, old)


def test_a_small_driver_gets_a_small_broadcast_limit(spark, monkeypatch, tmp_path):
    """A table of half a million keys, of a few MB in Parquet, would take a large part of 750 MB as a hash table."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    keys = spark.range(500_000).select("id", F.xxhash64("id").alias("key"))
    keys.write.parquet(str(tmp_path / "keys"))

    def plan() -> str:
        table = spark.read.parquet(str(tmp_path / "keys"))
        joined = spark.range(1_000_000_000).withColumnRenamed("id", "key").join(table, "key")
        return joined._jdf.queryExecution().sparkPlan().toString()

    try:
        for heap, broadcast in ((750 << 20, False), (8 << 30, True)):
            monkeypatch.setattr(session, "driver_heap", lambda spark, heap=heap: heap, raising=False)
            spark.conf.unset(key)
            session.tune(spark)
            assert ("BroadcastHashJoin" in plan()) == broadcast
    finally:
        spark.conf.set(key, old)


def test_ingest_two_slices(spark, tmp_path):
    views = SampleViews(spark, FOLDER)
    raw = (views.raw_transactions(), views.tokens(), views.transfers(), views.raw_contracts())
    days = ["2024-01-01", "2024-01-11", "2024-02-01"]
    paths = [
        ingest_slice(*raw, str(tmp_path / str(i)), days[i], days[i + 1]) for i in range(2)
    ]
    whole = ingest_slice(*raw, str(tmp_path / "whole"), days[0], dt.date(2024, 2, 1))
    both = read_slices(spark, [p["transactions"] for p in paths])
    assert rows(both) == rows(read_slices(spark, [whole["transactions"]]))
    assert both.count() > 500


@pytest.mark.parametrize("n_files", [None, 3])
def test_export(spark, tmp_path, n_files):
    stages = SampleViews(spark, FOLDER).pipeline()
    paths = stages.export(str(tmp_path), n_files)
    assert len(paths) == 14
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert read["real_portfolios"].count() == 788
    assert read["indexed_pairs"].count() == read["filtered_pairs"].count() == 341
    assert read["user_map"].count() == 150 and read["ranks"].count() == 150
    assert read["wallet_sample"].columns == ["id", "pagerank", "tier"]
    assert read["indexed_transfers"].count() == read["processed_transfers"].count() == 2684


def test_export_model(spark, tmp_path):
    stages = SampleViews(spark, FOLDER).pipeline()
    grid = [recommend.AlsSetting(2, 0.1, 15.0), recommend.AlsSetting(3, 0.1, 15.0)]
    paths = stages.export_model(str(tmp_path), grid, max_iter=2)
    choice = spark.read.parquet(paths["model_choice"]).collect()
    metrics = {r.k: r for r in spark.read.parquet(paths["ranking_metrics"]).collect()}
    best = next(r for r in choice if r.best)
    assert len(choice) == 2 and best.ndcg == metrics[10].ndcg and best.users == metrics[10].users_eval
    model = recommend.load_model(paths["model"])
    assert f"rank={model.rank} " in best.label


def test_properties(spark):
    stages = SampleViews(spark, FOLDER).pipeline()
    # What one wallet gains another loses.
    per_token = stages.flows.groupBy("token_address").agg(F.sum("value").alias("net"))
    assert per_token.filter("net <> 0").count() == 0
    # Raising either threshold never adds anything.
    grid = {
        (r.min_tx, r.min_holders): (r.entries, r.users, r.tokens)
        for r in matrix.threshold_grid(stages.stored_scored, [1, 29, 33, 36], [1, 8, 11, 16]).collect()
    }
    assert len(grid) == 16
    for (tx, holders), sizes in grid.items():
        for (other_tx, other_holders), smaller in grid.items():
            if other_tx >= tx and other_holders >= holders:
                assert all(a >= b for a, b in zip(sizes, smaller))
    ranks = stages.ranks.agg(F.min("pagerank"), F.sum("pagerank"), F.count("id")).first()
    assert ranks[0] >= 0.15 and ranks[1] == pytest.approx(ranks[2])  # no sinks in this graph
    metrics = evaluate.ranking_metrics(
        evaluate.rank_recs(popularity_recs(stages)), stages.split[1]
    ).collect()
    for row in metrics:
        assert all(0 <= row[name] <= 1 for name in ("precision", "recall", "ndcg", "hit_rate"))
