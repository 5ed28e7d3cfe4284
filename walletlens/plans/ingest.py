"""Cut date slices out of the raw tables and store them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from walletlens.sources import extracts
from walletlens.sources.days import write_days
from walletlens.sources.tables import write_table

# Fixed value: contracts are taken from this day on, whatever the slice.
CONTRACTS_FROM = "2023-01-01"


def ingest_slice(
    transactions: DataFrame,
    tokens: DataFrame,
    transfers: DataFrame,
    contracts: DataFrame,
    folder: str,
    start: str | dt.date,
    end: str | dt.date,
    contracts_from: str | dt.date = CONTRACTS_FROM,
) -> dict[str, str]:
    """Write one slice of every raw table below ``folder``; returns name to path.

    Slices of several ranges are put together again with ``sources.tables.read_slices``.
    """
    slices = {
        "transactions": extracts.extract_transactions(transactions, start, end),
        "tokens": extracts.extract_tokens(tokens),
        "token_transfers": extracts.extract_transfers(transfers, start, end),
        "contracts": extracts.extract_contracts(contracts, contracts_from, end),
    }
    paths = {name: f"{folder}/{name}" for name in slices}
    for name, table in slices.items():
        write_table(table, paths[name])
    return paths


def ingest_days(
    transactions: DataFrame, transfers: DataFrame, folder: str, start: str | dt.date, end: str | dt.date
) -> dict[str, list[dt.date]]:
    """Put the days from ``start`` up to ``end`` of the dated tables in place below ``folder``; returns name to days.

    Other days of these tables stay, so a range can be run again at any time; see ``sources.days``.
    """
    slices = {
        "transactions": extracts.extract_transactions(transactions, start, end),
        "token_transfers": extracts.extract_transfers(transfers, start, end),
    }
    return {name: write_days(table, f"{folder}/{name}", start, end) for name, table in slices.items()}
