from __future__ import annotations

import bisect
import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from walletlens.operators import distribution, gas

TX = "from_address string, block_timestamp timestamp, gas_price double"


def hour(h, day=1):
    return dt.datetime(2026, 3, day, h, 30)


def test_user_gas_hourly(spark):
    txs = spark.createDataFrame(
        [("A", hour(1), 10.0), ("a", hour(1), 30.0), ("a", hour(2), 5.0), ("b", hour(1), 7.0),
         (None, hour(1), 1.0)],
        TX,
    )
    users = spark.createDataFrame([("A",), ("a",), ("z",)], "user_address string")
    day = dt.date(2026, 3, 1)
    assert rows(gas.user_gas_hourly(txs, users)) == [("a", day, 1, 20.0), ("a", day, 2, 5.0)]


def nearest_rank(values, q):
    return sorted(values)[max(math.ceil(round(q * len(values), 9)), 1) - 1]


def test_exact_cutoff_with_a_hot_value(spark):
    random.seed(1)
    # A third of all rows share one price.
    values = [7.0] * 700 + [float(random.randint(0, 500)) for _ in range(1400)]
    txs = spark.createDataFrame([("a", hour(1), v) for v in values], TX).repartition(8)
    for q in (0.1, 0.34, 0.5, 0.95, 1.0):
        assert gas.gas_cutoff(txs, q, rel_err=0).first().cutoff == nearest_rank(values, q)
    approx = gas.gas_cutoff(txs).first().cutoff
    position = sum(v <= approx for v in values) / len(values)
    assert 0.93 <= position <= 0.97


def test_baseline_scopes(spark):
    cheap = [("a", hour(1), float(v)) for v in range(1, 21)]
    dear = [("a", hour(2), 100.0 + v) for v in range(20)] + [("a", None, 1.0), ("a", hour(3), None)]
    txs = spark.createDataFrame(cheap + dear, TX)
    overall = gas.gas_baseline_hourly(txs, rel_err=0)
    assert rows(overall, "hour", "baseline_gas_price", "n_samples") == [
        (1, 10.0, 20), (2, 108.0, 18),
    ]
    within = gas.gas_baseline_hourly(txs, scope="hour")
    assert rows(within, "hour", "baseline_gas_price", "n_samples") == [
        (1, 10.0, 19), (2, 109.0, 19),
    ]
    with pytest.raises(ValueError):
        gas.gas_baseline_hourly(txs, scope="day")


def activity(spark, values):
    return spark.createDataFrame([(int(v),) for v in values], "total_tx_count bigint")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4999), min_size=1, max_size=60))
def test_histogram_matches_numpy(spark, values):
    counts, edges = np.histogram(values, bins=50)
    got = distribution.activity_histogram(activity(spark, values)).orderBy("bin").collect()
    assert [r.users for r in got] == counts.tolist()
    assert np.allclose([r.lower_edge for r in got], edges[:-1])
    assert np.allclose([r.upper_edge for r in got], edges[1:])


def test_histogram_of_one_value(spark):
    got = distribution.activity_histogram(activity(spark, [7, 7, 7])).filter("users > 0").collect()
    assert len(got) == 1 and got[0].users == 3
    assert got[0].lower_edge <= 7 <= got[0].upper_edge


def test_pareto_matches_a_cumulative_sum(spark):
    random.seed(2)
    values = [random.choice([1, 1, 1, 2, 3, 50, 400]) for _ in range(500)]
    ordered = np.sort(values)[::-1]
    tx_share = np.cumsum(ordered) / np.sum(ordered)
    curve = distribution.pareto_curve(activity(spark, values))
    for row in curve.collect():
        assert row.user_share == pytest.approx(row.cum_users / 500)
        assert row.tx_share == pytest.approx(tx_share[row.cum_users - 1])
    points = distribution.pareto_points(curve).first()
    shares = np.arange(1, 501) / 500
    assert points.tx_share_of_top == pytest.approx(np.interp(0.01, shares, tx_share))
    grid_x, grid_y = np.insert(tx_share, 0, 0.0), np.insert(shares, 0, 0.0)
    assert points.users_for_share == pytest.approx(np.interp(0.8, grid_x, grid_y))


@pytest.mark.parametrize("q", [0.01, 0.5, 0.95, 1.0])
def test_default_cut_and_sketches_are_near_in_rank(spark, q):
    prices = spark.range(0, 40_000, 1, 8).select(
        F.expr("timestamp_seconds(1704067200 + id * 97)").alias("block_timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 7.0).alias("gas_price"),
    )
    ordered = sorted(r[0] for r in prices.select("gas_price").collect())
    sketches = gas.gas_sketches(prices)
    assert sketches.count() > 40
    merged = gas.sketched_cutoff(sketches.repartition(5), q).first()
    assert merged["samples"] == 40_000
    for cutoff in (merged["cutoff"], gas.gas_cutoff(prices, q).first()["cutoff"]):
        rank = bisect.bisect_right(ordered, cutoff)
        assert abs(rank / 40_000 - q) <= gas.RANK_ERROR
    assert gas.gas_cutoff(prices, q, rel_err=0).first()["cutoff"] == ordered[math.ceil(q * 40_000) - 1]


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "block_timestamp timestamp, gas_price double")
    assert tuple(gas.sketched_cutoff(gas.gas_sketches(none)).first()) == (None, 0)
    some = spark.createDataFrame([("2024-01-01", None), (None, 5.0), ("2024-01-01", 7.0)], "t string, gas_price double")
    some = some.select(F.to_timestamp("t").alias("block_timestamp"), "gas_price")
    assert tuple(gas.sketched_cutoff(gas.gas_sketches(some)).first()) == (7.0, 1)
