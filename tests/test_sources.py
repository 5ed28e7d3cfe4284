from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from walletlens import schemas
from walletlens.functions.shared_storage import broadcast_if_at_most, scratch_path, shared_root
from walletlens.sources import extracts, tables

ZERO = "0x" + "0" * 40
DAY = dt.datetime(2026, 3, 25)


def test_extract_transactions(spark):
    raw = spark.createDataFrame(
        [
            ("in", "a", "b", Decimal(2 * 10**18), DAY, 5, 1),
            ("first day", "a", "b", Decimal(10**17), dt.datetime(2026, 3, 21), 5, 1),
            ("day before", "a", "b", Decimal(1), dt.datetime(2026, 3, 20, 23, 59, 59), 5, 1),
            ("end day", "a", "b", Decimal(1), dt.datetime(2026, 4, 1), 5, 1),
            ("last second", "a", "b", Decimal(0), dt.datetime(2026, 3, 31, 23, 59, 59), 5, 1),
            ("failed", "a", "b", Decimal(1), DAY, 5, 0),
            ("no receiver", "a", None, Decimal(1), DAY, 5, 1),
        ],
        "hash string, from_address string, to_address string, value decimal(38,0), "
        "block_timestamp timestamp, gas_price bigint, receipt_status int",
    )
    got = extracts.extract_transactions(raw, "2026-03-21", "2026-04-01")
    assert rows(got, "hash", "eth_value") == [("first day", 0.1), ("in", 2.0), ("last second", 0.0)]
    assert got.columns == schemas.TRANSACTIONS.names


def test_extract_tokens(spark):
    good = ("0x1", "S", "Name", "6", "1000")
    raw = spark.createDataFrame(
        [
            good,
            ("0x2", None, "Name", "6", "1000"),
            ("0x3", "S", None, "6", "1000"),
            ("0x4", "S", "Name", None, "1000"),
            ("0x5", "S", "Name", "6", None),
            ("0x6", "S", "Name", "6", "0"),
            ("0x7", "S", "Name", "6", "-1"),
            ("0x8", "S", "Name", "6", "x"),
            ("0x9", "S", "Name", "6", "9" * 40),
        ],
        schemas.TOKENS,
    )
    assert rows(extracts.extract_tokens(raw)) == [good]


def test_extract_transfers(spark):
    def row(name, value="7", sender="0xa", receiver="0xb", day=DAY):
        return ("0xt", sender, receiver, value, name, day)

    raw = spark.createDataFrame(
        [
            row("plain"),
            row("mint", sender=ZERO),
            row("empty", value="0"),
            row("burn", receiver=ZERO),
            row("lost", receiver=None),
            row("first", day=dt.datetime(2026, 3, 21)),
            row("end", day=dt.datetime(2026, 4, 1)),
            row("early", day=dt.datetime(2026, 3, 20)),
        ],
        schemas.TRANSFERS,
    )
    got = extracts.extract_transfers(raw, "2026-03-21", "2026-04-01")
    assert rows(got, "transaction_hash") == [("first",), ("mint",), ("plain",)]


def test_extract_contracts(spark):
    raw = spark.createDataFrame(
        [
            ("0x1", True, False, dt.datetime(2023, 1, 1)),
            ("0x2", False, True, dt.datetime(2026, 4, 1)),
            ("0x3", None, None, dt.datetime(2022, 12, 31)),
        ],
        schemas.RAW_CONTRACTS,
    )
    got = extracts.extract_contracts(raw, "2023-01-01", dt.date(2026, 4, 1))
    assert rows(got) == [("0x1", True, False)]


def test_date_range_reaches_the_scan(spark, tmp_path):
    raw = spark.createDataFrame([("0x1", True, False, DAY)], schemas.RAW_CONTRACTS)
    raw.write.parquet(str(tmp_path / "c"))
    plan = extracts.extract_contracts(
        spark.read.parquet(str(tmp_path / "c")), "2023-01-01", "2026-04-01"
    )._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(block_timestamp" in pushed and "LessThan(" in pushed


def test_slices_and_first_available(spark, tmp_path):
    paths = [str(tmp_path / f"s{i}") for i in range(3)]
    for i, path in enumerate(paths):
        tables.write_table(spark.range(i * 10, i * 10 + 5), path)
    assert tables.read_slices(spark, paths).count() == 15
    missing = str(tmp_path / "missing")
    assert tables.read_first_available(spark, [missing, paths[1]]).count() == 5
    with pytest.raises(FileNotFoundError):
        tables.read_first_available(spark, [missing])
    (tmp_path / "broken").mkdir()
    with pytest.raises(AnalysisException):
        tables.read_first_available(spark, [str(tmp_path / "broken"), paths[0]])


def test_token_csv_quoting(spark, tmp_path):
    path = tmp_path / "tokens.csv"
    path.write_text(
        "address,symbol,name\n"
        '0x1,"A,B","line\nbreak"\n'
        '0x2,C,"say ""hi"""\n'
    )
    assert rows(tables.read_token_csv(spark, str(path))) == [
        ("0x1", "A,B", "line\nbreak"),
        ("0x2", "C", 'say "hi"'),
    ]
    out = str(tmp_path / "again")
    tables.write_table(tables.read_token_csv(spark, str(path)), out, fmt="csv", n_files=2)
    assert rows(tables.read_token_csv(spark, out)) == rows(tables.read_token_csv(spark, str(path)))


def test_write_table_files_and_overwrite(spark, tmp_path):
    path = tmp_path / "out"
    tables.write_table(spark.range(100), str(path), n_files=10)
    tables.write_table(spark.range(1000), str(path), n_files=10)
    assert spark.read.parquet(str(path)).count() == 1000
    assert len(list(path.glob("part-*"))) == 10


def test_catalog_table(spark):
    saved = tables.save_catalog_table(spark.range(4), "ranks_for_test")
    try:
        assert saved.count() == 4
    finally:
        spark.sql("drop table ranks_for_test")


def test_shared_folder_comes_from_the_session(spark):
    # Where the session names no folder, local mode makes one and keeps to it.
    root = spark.conf.get("spark.checkpoint.dir", None) or shared_root(spark)
    assert shared_root(spark) == root
    assert scratch_path(spark).startswith(root)
    assert scratch_path(spark) != scratch_path(spark)


def test_broadcast_only_within_the_limit(spark):
    small = spark.range(10)

    def plan(limit):
        joined = spark.range(100).hint("merge").join(broadcast_if_at_most(small, limit), "id")
        return joined._jdf.queryExecution().analyzed().toString()

    assert "strategy=broadcast" in plan(10)
    assert "strategy=broadcast" not in plan(9)
