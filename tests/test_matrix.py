from __future__ import annotations

import pytest
import random

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from walletlens import schemas
from walletlens.functions.distinct import distinct_counts
from walletlens.functions.ordering import number_rows, running_totals
from walletlens.operators import matrix


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab09é", max_size=6), min_size=1, max_size=80))
def test_dense_ids_are_consecutive_and_ordered(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = {r.k: r.id for r in matrix.dense_ids(df, "k", "id").collect()}
    want = sorted(set(keys), key=lambda k: k.encode())
    assert got == {k: i + 1 for i, k in enumerate(want)}


def test_numbering_over_many_ranges(spark):
    df = spark.range(20000).withColumn("k", F.md5(F.col("id").cast("string"))).repartition(16)
    got = number_rows(df, ["k"], "n", start=0).orderBy("n").collect()
    assert [r.n for r in got] == list(range(20000))
    assert [r.k for r in got] == sorted(r.k for r in got)


def test_running_totals(spark):
    random.seed(3)
    data = [(i, random.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    got = running_totals(df, [F.desc("k")], {"upto": "v"}).orderBy(F.desc("k")).collect()
    total = 0
    for row, (key, value) in zip(got, reversed(data)):
        total += value
        assert (row.k, row.v, row.upto) == (key, value, total)


def test_wallets_and_assets(spark):
    transfers = spark.createDataFrame(
        [("A", "b"), ("a", ""), (None, "C"), ("b", " ")], "from_address string, to_address string"
    )
    assert rows(matrix.wallet_universe(transfers)) == [(" ",), ("a",), ("b",), ("c",)]
    good = "0x" + "aB" * 20
    listed = spark.createDataFrame(
        [(f" {good} ",), (good.lower(),), ("0x12",), ("0x" + "g" * 40,), (good + "0",), (None,)],
        "address string",
    )
    assert rows(matrix.valid_token_addresses(listed)) == [(good.lower(),)]


def maps(spark):
    users = spark.createDataFrame([("a", 1), ("b", 2)], schemas.USER_MAP)
    tokens = spark.createDataFrame([("t", 1)], schemas.TOKEN_MAP)
    return users, tokens


def test_index_pairs(spark):
    pairs = spark.createDataFrame(
        [("A", "T", 5, "x"), ("b", "u", 6, "x"), ("c", "t", 7, "x"), ("", "t", 8, "x"),
         ("a", None, 9, "x")],
        "user_address string, token_address string, total_tx bigint, note string",
    )
    got = matrix.index_pairs(pairs, *maps(spark))
    assert got.columns == ["user_id", "token_id", "total_tx", "note"]
    assert rows(got) == [(1, 1, 5, "x")]
    held = spark.createDataFrame(
        [("a", "t", 1.0, 3), ("c", "t", 2.0, 4)],
        "user_address string, token_address string, balance double, tx_count bigint",
    )
    assert rows(matrix.index_pairs_left(held, *maps(spark))) == [(1, 1, 1.0, 3), (None, 1, 2.0, 4)]


def test_index_transfers_keeps_unmapped_rows(spark):
    transfers = spark.createDataFrame(
        [("A", "B", "T", 1.0), ("a", "z", "t", 2.0), (None, "b", "u", 3.0)],
        schemas.PROCESSED_TRANSFERS,
    )
    got = matrix.index_transfers(transfers, *maps(spark))
    assert got.columns == schemas.INDEXED_TRANSFERS.names
    assert rows(got) == [(1, 2, 1, 1.0), (1, None, 1, 2.0), (None, 2, None, 3.0)]
    assert rows(matrix.unmapped_count(got)) == [(3, 2)]


def test_sparsity(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "u int, i int")
    assert rows(matrix.sparsity(df, "u", "i")) == [(3, 2, 2, 25.0)]
    assert rows(matrix.sparsity(df.limit(0), "u", "i")) == [(0, 0, 0, 100.0)]
    assert rows(matrix.sparsity(df, "u", "i", approximate=True)) == [(3, 2, 2, 25.0)]


def random_holdings(spark, seed=4):
    random.seed(seed)
    # One wallet and one asset appear in about a third of the rows each.
    pairs = {("hub", f"t{i}") for i in range(200)} | {(f"u{i}", "hot") for i in range(200)}
    pairs |= {(f"u{random.randrange(60)}", f"t{random.randrange(60)}") for _ in range(250)}
    data = [(u, t, random.randint(1, 9)) for u, t in sorted(pairs)]
    df = spark.createDataFrame(data, "user_address string, token_address string, tx_count bigint")
    return data, df


def test_scores_and_grid_match_brute_force(spark):
    data, df = random_holdings(spark)
    total, holders = {}, {}
    for user, token, n in data:
        total[user] = total.get(user, 0) + n
        holders[token] = holders.get(token, 0) + 1
    scored = matrix.score_pairs(df)
    want = [(u, t, total[u], holders[t]) for u, t, _ in data]
    assert rows(scored) == sorted(want, key=str)
    assert rows(matrix.user_totals(df)) == sorted(total.items(), key=str)
    assert rows(matrix.token_holders(df)) == sorted(holders.items(), key=str)

    txs, limits = [50, 10, 100000], [2, 5, 100]
    expected = []
    for min_tx in txs:
        for limit in limits:
            cell = [r for r in want if r[2] >= min_tx and r[3] >= limit]
            users, tokens = len({r[0] for r in cell}), len({r[1] for r in cell})
            empty = round((1 - len(cell) / (users * tokens)) * 100, 4) if cell else 100.0
            expected.append((min_tx, limit, len(cell), users, tokens, empty))
    grid = matrix.threshold_grid(scored, txs, limits)
    assert rows(grid) == sorted(expected, key=str)
    shares = [r.sparsity_pct for r in grid.collect()]
    assert shares == sorted(shares)
    kept = matrix.filter_pairs(scored, 10, 5)
    assert kept.count() == sum(1 for r in want if r[2] >= 10 and r[3] >= 5)


def test_grid_with_totals_that_differ_by_pair(spark):
    random.seed(4)
    data = sorted(
        {(f"u{random.randrange(30)}", f"t{random.randrange(12)}"): None for _ in range(200)}
    )
    rows_in = [(u, t, random.randrange(1, 80), random.randrange(1, 80)) for u, t in data]
    rows_in += [("one", "a", 60, 12), ("one", "b", 12, 60)]
    scored = spark.createDataFrame(
        rows_in, "user_address string, token_address string, total_tx long, num_holders long"
    )
    got = {(r.min_tx, r.min_holders): (r.entries, r.users, r.tokens) for r in matrix.threshold_grid(scored).collect()}
    for t in (10, 20, 50):
        for h in (10, 20, 50):
            cell = [r for r in rows_in if r[2] >= t and r[3] >= h]
            assert got[t, h] == (len(cell), len({r[0] for r in cell}), len({r[1] for r in cell}))
    with pytest.raises(ValueError):
        matrix.threshold_grid(scored, range(1, 9), range(1, 9))


def test_pair_counts_come_along(spark):
    held = spark.createDataFrame([("u", "t", 3), ("u", "s", 4)], "user_address string, token_address string, tx_count long")
    assert rows(matrix.score_pairs(held, pair_counts=True)) == [("u", "s", 4, 7, 1), ("u", "t", 3, 7, 1)]


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_distinct_counts(spark, kind):
    values = [(1, None), (None, None), (1, 5), (-3, 5), (70_000, -5), (32_768, 0), (32_769, 2**31 - 1), (None, 5)]
    df = spark.createDataFrame(values, "a bigint, b bigint").select(*[F.col(c).cast(kind).alias(c) for c in "ab"])
    counted = distinct_counts(df.repartition(4), {"x": F.col("a"), "y": F.col("b"), "z": F.when(F.col("a") > 0, F.col("b"))})
    assert rows(counted) == [(8, 5, 4, 4)]
    assert rows(distinct_counts(df.limit(0), {"x": F.col("a")})) == [(0, 0)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    if kind != "string":  # what is shuffled is bitmaps, not values
        assert "bitmap_construct_agg" in plan.split("Exchange hashpartitioning")[-1]
