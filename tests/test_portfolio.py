from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from walletlens import schemas
from walletlens.operators import clean, portfolio

DAY = dt.datetime(2026, 3, 25)
TRANSFER = (
    "token_address string, from_address string, to_address string, value string, "
    "transaction_hash string, block_timestamp timestamp"
)


def tokens(spark, *pairs):
    data = [(a, "S", "N", d, "1") for a, d in pairs]
    return spark.createDataFrame(data, schemas.TOKENS)


def test_clean_tokens_keeps_one_usable_row(spark):
    raw = tokens(
        spark, ("0xA", None), ("0xa", "6"), ("0xb", "x"), ("0xc", "18"), ("0xd", "19"),
        ("0xe", "19"), ("0xE", "6"), ("0xf", "9"), ("0xf", "8"),
    )
    assert rows(clean.clean_tokens(raw), "address", "decimals") == [
        ("0xa", 6), ("0xc", 18), ("0xe", 6), ("0xf", 8),
    ]


def test_amounts(spark):
    values = ["123", "9" * 39, "abc", "", "1.6", None]
    raw = spark.createDataFrame(
        [("0xT", "a", "b", v, str(i), DAY) for i, v in enumerate(values)], TRANSFER
    )
    cleaned = clean.clean_tokens(tokens(spark, ("0xt", "0")))
    got = clean.normalize_transfers(raw, cleaned)
    assert [r.adjusted_value for r in got.orderBy("transaction_hash").collect()] == [
        123.0, None, None, None, 2.0, None,
    ]
    assert len(got.columns) == 9
    assert clean.processed_transfers(got).columns == schemas.PROCESSED_TRANSFERS.names


def test_flows_and_portfolios(spark):
    raw = spark.createDataFrame(
        [
            ("0xt", "0xS", "0xs", "500", "self", DAY),
            ("0xt", "0x0", "0xM", "700", "mint", DAY),
            ("0xt", None, "0xn", "100", "no sender", DAY),
            ("0xt", "0xm", "0xr", "200", "later", DAY + dt.timedelta(days=1)),
            ("0xt", "0xm", "0xr", "huge", "no amount", DAY),
            ("0xu", "0xm", "0xr", "100", "unknown asset", DAY),
        ],
        TRANSFER,
    )
    normalized = clean.normalize_transfers(raw, clean.clean_tokens(tokens(spark, ("0xt", "2"))))
    flows = portfolio.signed_flows(normalized)
    assert flows.count() == 10
    assert flows.agg(F.sum("value")).first()[0] == 0.0
    assert rows(portfolio.portfolios(flows), "user_address", "balance", "tx_count") == [
        ("0xm", 5.0, 3), ("0xn", 1.0, 1), ("0xr", 2.0, 2),
    ]
    last = portfolio.portfolios(flows).filter("user_address = '0xr'").first().last_active
    assert last == DAY + dt.timedelta(days=1)


def held(spark, data):
    return spark.createDataFrame(
        [(u, t, 1.0, n, DAY) for u, t, n in data],
        "user_address string, token_address string, balance double, tx_count bigint, "
        "last_active timestamp",
    )


def test_labels_and_exchange_cut(spark):
    p = held(spark, [("a", "t", 4999), ("b", "t", 2500), ("b", "u", 2500), ("c", "t", 5001),
                     ("k", "t", 1), ("k", "u", 1)])
    known = portfolio.contract_addresses(
        spark.createDataFrame([("K",), ("k",), ("z",)], "address string")
    )
    assert rows(known) == [("k",), ("z",)]
    labelled = portfolio.label_contracts(p, known)
    assert labelled.columns == schemas.PORTFOLIOS.names
    assert rows(portfolio.label_counts(labelled)) == [(6, 2, 4)]
    users = portfolio.real_users(labelled)
    assert rows(users) == [("a", 4999)]
    assert rows(portfolio.real_portfolios(labelled, users), "user_address") == [("a",)]
    wider = portfolio.real_portfolios(labelled, portfolio.real_users(labelled, 5001))
    assert rows(wider, "user_address") == [("a",), ("b",), ("b",)]
    assert rows(portfolio.user_activity(wider)) == [("a", 1, 4999, 1), ("b", 2, 5000, 2)]
    ordered = [r.user_address for r in portfolio.user_activity(wider, ordered=True).collect()]
    assert ordered == ["b", "a"]


def test_fractions_that_come_to_nothing(spark):
    moves = [("0xm", "0xw", "100000000000000000"), ("0xm", "0xw", "200000000000000000"), ("0xw", "0xm", "300000000000000000"),
             ("0xm", "0xk", "100000000000000000")]
    raw = spark.createDataFrame([("0xt", a, b, v, str(i), DAY) for i, (a, b, v) in enumerate(moves)], TRANSFER)
    cleaned = clean.clean_tokens(tokens(spark, ("0xt", "18")))
    for partitions in (1, 64):
        exact = clean.normalize_transfers(raw.repartition(partitions), cleaned, keep_amount=True)
        held = portfolio.portfolios(portfolio.signed_flows(exact))
        assert rows(held, "user_address", "balance", "tx_count") == [("0xk", 0.1, 1)]


def test_sums_beyond_the_decimal_fall_back(spark):
    raw = spark.createDataFrame(
        [("0xt", "0xa", "0xb", "9" * 38, str(i), DAY) for i in range(3)], TRANSFER
    )
    exact = clean.normalize_transfers(raw, clean.clean_tokens(tokens(spark, ("0xt", "0"))), keep_amount=True)
    held = portfolio.portfolios(portfolio.signed_flows(exact)).collect()
    assert [(r.user_address, r.tx_count) for r in held] == [("0xb", 3)]
    assert abs(held[0].balance / 3e38 - 1) < 1e-9
