"""Date-sliced extracts of the raw chain tables.

Dates are half-open ranges and are compared with the raw timestamp column, so they reach
the Parquet scan as pushed filters. A day begins at midnight in the session's zone, which
``session.tune`` sets to UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletlens.functions.columns import try_decimal

# Fixed values.
ZERO_ADDRESS = "0x" + "0" * 40
WEI_PER_ETH = 1e18
SUCCESS_STATUS = 1
NUMERIC_SCALE = 9


def within(start: str | dt.date, end: str | dt.date, column: str = "block_timestamp") -> Column:
    """From the first moment of ``start`` up to that of ``end``."""
    first, last = (dt.date.fromisoformat(str(day)) for day in (start, end))
    return (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last))


def extract_transactions(raw: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Successful transactions with a receiver; the value is converted from wei to ether."""
    return raw.filter(
        within(start, end)
        & (F.col("receipt_status") == SUCCESS_STATUS)
        & F.col("to_address").isNotNull()
    ).select(
        "hash",
        "from_address",
        "to_address",
        (F.col("value").cast(f"decimal(38,{NUMERIC_SCALE})").cast("double") / WEI_PER_ETH).alias(
            "eth_value"
        ),
        "block_timestamp",
        "gas_price",
    )


def extract_tokens(raw: DataFrame) -> DataFrame:
    """Fully described assets with a positive total supply that fits the numeric type."""
    columns = ["address", "symbol", "name", "decimals", "total_supply"]
    return (
        raw.select(*columns)
        .dropna(subset=columns[1:])
        .filter(try_decimal("total_supply", NUMERIC_SCALE) > 0)
    )


def extract_transfers(raw: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Non-empty transfers to a live receiver; mints (zero sender) stay."""
    return raw.filter(
        within(start, end)
        & (F.col("value") != "0")
        & F.col("to_address").isNotNull()
        & (F.col("to_address") != ZERO_ADDRESS)
    ).select(
        "token_address",
        "from_address",
        "to_address",
        "value",
        "transaction_hash",
        "block_timestamp",
    )


def extract_contracts(raw: DataFrame, start: str | dt.date, end: str | dt.date) -> DataFrame:
    """Contracts deployed in the range with their standard flags."""
    return raw.filter(within(start, end)).select("address", "is_erc20", "is_erc721")
