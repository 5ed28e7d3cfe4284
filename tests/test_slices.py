"""Published versions, slices by day, balances over slices and lasting ids."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from walletlens.functions.files import Store
from walletlens.operators import balances, lasting_ids, portfolio
from walletlens.plans.ingest import ingest_days
from walletlens.sources import days, versions
from walletlens.sources.versions import Buckets

from conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Versions ---------------------------------------------------------------------------------------------------


def test_reader_sees_whole_versions_only(spark, tmp_path):
    root = str(tmp_path / "table")
    assert versions.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.read_published(spark, root)
    versions.publish(spark.range(3).toDF("id"), root)
    reader = versions.read_published(spark, root)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        versions.publish(broken, root)
    assert rows(reader) == rows(versions.read_published(spark, root)) == [(0,), (1,), (2,)]
    second = versions.publish(spark.range(2).toDF("id"), root, notes={"why": "é"})
    assert rows(reader) == [(0,), (1,), (2,)]  # opened before, still there
    assert second.number == 2 and versions.current_version(spark, root).notes == {"why": "é"}
    assert rows(versions.read_published(spark, root)) == [(0,), (1,)]
    assert rows(versions.read_published(spark, root, 1)) == [(0,), (1,), (2,)]
    # The failed write's folder went with the clean-up, and so does the first version with the third.
    versions.publish(spark.range(1).toDF("id"), root)
    store = Store(spark, root)
    assert len([n for n in store.names(root) if n.startswith("data-")]) == 2
    assert store.names(f"{root}/_versions") == ["0000000002", "0000000003"]


def test_appended_rows_join_those_before(spark, tmp_path):
    root = str(tmp_path / "table")
    versions.publish(spark.range(3).toDF("id"), root)
    version = versions.publish(spark.range(3, 5).toDF("id"), root, append=True)
    assert len(version.folders) == 2
    assert rows(versions.read_published(spark, root)) == [(i,) for i in range(5)]
    with pytest.raises(ValueError):
        versions.publish(spark.range(3).toDF("other"), root, append=True)
    with pytest.raises(ValueError):
        versions.publish(spark.range(3).toDF("id"), root, append=True, buckets=Buckets(("id",), 4))
    versions.unpublish(spark, root)
    assert versions.current_version(spark, root) is None


def test_a_number_is_given_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.create(f"{tmp_path}/a", "one")
    with pytest.raises(FileExistsError):
        store.create(f"{tmp_path}/a", "two")
    assert store.read(f"{tmp_path}/a") == "one" and store.names(f"{tmp_path}/none") == []


@pytest.fixture()
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_bucketed_versions_join_without_exchange(spark, tmp_path, no_broadcast):
    buckets = Buckets(("key",), 6)
    roots = [str(tmp_path / name) for name in ("left", "right")]
    for root in roots:
        versions.publish(spark.range(1000).select(F.col("id").alias("key"), F.lit(root).alias("of")), root, buckets=buckets)
    left, right = (versions.read_published(spark, root) for root in roots)
    joined = left.join(right, "key")
    assert joined.count() == 1000
    assert "Exchange" not in plan_of(joined)
    # Another session has to find the buckets by itself.
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left, right = (versions.read_published(other, root) for root in roots)
    assert "Exchange" not in plan_of(left.join(right, "key"))


# Slices by day ----------------------------------------------------------------------------------------------

DAYS = "id long, block_timestamp timestamp"


def events(spark, *told):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in told], DAYS)


def test_a_rerun_replaces_its_days_only(spark, tmp_path):
    path = str(tmp_path / "days")
    first = events(spark, (1, "2024-01-01T00:00:00"), (2, "2024-01-02T23:59:59"), (3, "2024-01-03T05:00:00"),
                   (4, "2024-01-04T05:00:00"), (9, "2024-02-01T00:00:00"))
    assert days.write_days(first, path, "2024-01-01", "2024-01-05") == [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    files = {n: Store(spark, path).names(f"{path}/{n}") for n in Store(spark, path).names(path) if n.startswith("day=")}
    # The second of January is corrected, the third has lost its rows.
    again = events(spark, (20, "2024-01-02T12:00:00"), (21, "2024-01-02T13:00:00"))
    days.write_days(again, path, "2024-01-02", dt.date(2024, 1, 4))
    read = days.read_days(spark, path, first.schema, "2024-01-01", "2024-02-02")
    assert rows(read, "id") == [(1,), (20,), (21,), (4,)]
    after = {n: Store(spark, path).names(f"{path}/{n}") for n in Store(spark, path).names(path) if n.startswith("day=")}
    assert sorted(after) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-04"]
    assert all(after[n] == files[n] for n in ("day=2024-01-01", "day=2024-01-04"))
    with pytest.raises(ValueError):
        days.write_days(again, path, "2024-01-02", "2024-01-02")


def test_only_asked_days_are_opened(spark, tmp_path):
    path = str(tmp_path / "days")
    month = events(spark, *((d, f"2024-01-{d:02d}T01:00:00") for d in range(1, 31)))
    days.write_days(month, path, "2024-01-01", "2024-02-01")
    read = days.read_days(spark, path, month.schema, "2024-01-10", "2024-01-12")
    assert rows(read) == [(10, dt.datetime(2024, 1, 10, 1), dt.date(2024, 1, 10)),
                          (11, dt.datetime(2024, 1, 11, 1), dt.date(2024, 1, 11))]
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan_of(read))


def test_a_busy_day_is_dealt_to_several_tasks(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        busy = spark.range(200_000).select("id", F.expr("timestamp '2024-01-01 00:00:00'").alias("block_timestamp"))
        days.write_days(busy.withColumn("id", F.xxhash64("id")).repartition(8), path, "2024-01-01", "2024-01-02")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([n for n in Store(spark, path).names(f"{path}/day=2024-01-01") if n.endswith(".parquet")]) > 1


def test_ingest_days(spark, tmp_path):
    zero = dt.datetime(2024, 1, 1, 12)
    transactions = spark.createDataFrame(
        [("h", "0xa", "0xb", Decimal(10), zero, 5, 1), ("i", "0xa", None, Decimal(10), zero, 5, 1)],
        "hash string, from_address string, to_address string, value decimal(38,9), block_timestamp timestamp, "
        "gas_price long, receipt_status int",
    )
    transfers = spark.createDataFrame(
        [("0xt", "0xa", "0xb", "7", "h", zero)],
        "token_address string, from_address string, to_address string, value string, transaction_hash string, "
        "block_timestamp timestamp",
    )
    for _ in range(2):
        found = ingest_days(transactions, transfers, str(tmp_path), "2024-01-01", "2024-01-03")
    assert found == {"transactions": [dt.date(2024, 1, 1)], "token_transfers": [dt.date(2024, 1, 1)]}
    read = days.read_days(spark, f"{tmp_path}/token_transfers", transfers.schema, "2024-01-01", "2024-01-03")
    assert read.count() == 1


# Balances over slices ---------------------------------------------------------------------------------------

FLOWS = (
    "user_address string, token_address string, value double, block_timestamp timestamp, "
    "amount decimal(38,0), decimals int"
)


def flow(user, token, amount, day, decimals=1):
    value = None if amount is None else amount / 10**decimals
    return user, token, value, dt.datetime(2024, 1, day), None if amount is None else Decimal(amount), decimals


def random_flows(seed, n=300):
    draw = random.Random(seed)
    amounts = [None, 1, 2, 3, -1, -2, -3, 10**20, -(10**20)]
    return [flow(draw.choice([None, *"abcd"]), draw.choice("xyz"), draw.choice(amounts), draw.randint(1, 30))
            for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_everything_at_once(spark, tmp_path, seed):
    flows = random_flows(seed) + [flow("only", "x", None, 1), flow("late", "x", None, 1), flow("late", "x", 4, 29)]
    table = spark.createDataFrame(flows, FLOWS)
    root = str(tmp_path / "state")
    for name, low, high in (("a", 1, 8), ("b", 8, 20), ("c", 20, 32)):
        part = table.where(F.dayofmonth("block_timestamp").between(low, high - 1))
        version = balances.add_slice(root, part, name, buckets=4)
    assert version.number == 3 and version.notes["slices"] == ["a", "b", "c"]
    want = portfolio.portfolios(table)
    got = balances.held_balances(versions.read_published(spark, root))
    assert got.columns == want.columns
    near = lambda df: rows(df.withColumn("balance", F.round("balance", 6)))
    assert near(got) == near(want)
    # A slice that is known counts once.
    assert balances.add_slice(root, table, "b").number == 3


def test_sums_beyond_38_digits_fall_back(spark):
    big = 9 * 10**37
    table = spark.createDataFrame([flow("a", "x", big, 1, 0), flow("a", "x", big, 2, 0), flow("a", "x", -1, 3, 0)], FLOWS)
    parts = [balances.slice_state(table.where(F.dayofmonth("block_timestamp") == d)) for d in (1, 2, 3)]
    state = balances.merged_state(balances.merged_state(parts[0], parts[1]), parts[2])
    assert state.first()["amount"] is None
    assert balances.held_balances(state).first()["balance"] == pytest.approx(2.0 * big)


def test_only_the_slice_is_exchanged(spark, tmp_path, no_broadcast):
    root = str(tmp_path / "state")
    table = spark.createDataFrame(random_flows(9), FLOWS)
    balances.add_slice(root, table, "first", buckets=4)
    later = balances.slice_state(table).repartition(4, *balances.KEYS)
    merged = balances.merged_state(versions.read_published(spark, root), later)
    state_side = plan_of(merged).split("SortMergeJoin")[1]
    scan = [line for line in state_side.splitlines() if "Scan parquet" in line or "FileScan" in line]
    before_scan = state_side[: state_side.index(scan[0])]
    assert "Exchange" not in before_scan and "Bucketed: true" in state_side


# Lasting ids ------------------------------------------------------------------------------------------------


def test_ids_stay_and_stay_dense(spark, tmp_path):
    root = str(tmp_path / "ids")
    table = lambda names: spark.createDataFrame([(n,) for n in names], "key string")
    known = {}
    for step, names in enumerate((["m", "c", None, "c"], ["c", "m"], ["a", "m", "z", "a"], [], ["b", "y", None])):
        version = lasting_ids.extend_ids(root, table(names), "key", "id", buckets=3)
        now = {r["key"]: r["id"] for r in lasting_ids.id_map(spark, root).collect()}
        assert now.items() >= known.items()
        assert sorted(now.values()) == list(range(1, len(now) + 1)) and version.notes["last_id"] == len(now)
        new = sorted(set(now) - set(known))
        assert [now[k] for k in new] == list(range(len(known) + 1, len(now) + 1))
        known = now
    assert known == {"c": 1, "m": 2, "a": 3, "z": 4, "b": 5, "y": 6}
    assert version.number == 3 and len(version.folders) == 3  # steps without new keys publish nothing
    compacted = lasting_ids.compact_ids(spark, root)
    assert len(compacted.folders) == 1
    assert {r["key"]: r["id"] for r in lasting_ids.id_map(spark, root).collect()} == known
    lasting_ids.extend_ids(root, table(["q"]), "key", "id")
    assert lasting_ids.id_map(spark, root).where("key = 'q'").first()["id"] == 7


def test_empty_dictionary(spark, tmp_path):
    root = str(tmp_path / "ids")
    lasting_ids.extend_ids(root, spark.createDataFrame([], "key string"), "key", "id", buckets=2)
    assert lasting_ids.id_map(spark, root).count() == 0
    lasting_ids.extend_ids(root, spark.createDataFrame([("a",)], "key string"), "key", "id")
    assert rows(lasting_ids.id_map(spark, root)) == [("a", 1)]
