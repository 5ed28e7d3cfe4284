"""Asset cleaning and amount normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.columns import try_decimal

# Fixed value: assets with more decimals are not analysed.
MAX_DECIMALS = 18


def clean_tokens(tokens: DataFrame, max_decimals: int = MAX_DECIMALS) -> DataFrame:
    """One row per lower-cased address with a usable number of decimals.

    Unusable rows go first, then the smallest row survives. A grouped minimum combines
    before the shuffle, so an address repeated millions of times costs one row per task.
    """
    rest = [c for c in tokens.columns if c not in ("address", "decimals")]
    return (
        tokens.select(
            F.lower("address").alias("address"),
            F.expr("try_cast(decimals as int)").alias("decimals"),
            *rest,
        )
        .filter(F.col("decimals") <= max_decimals)
        .groupBy("address")
        .agg(F.min(F.struct("decimals", *rest)).alias("survivor"))
        .select("address", "survivor.*")
    )


def normalize_transfers(
    transfers: DataFrame, tokens: DataFrame, keep_amount: bool = False
) -> DataFrame:
    """Transfers of cleaned assets with the amount scaled by the asset's decimals.

    Amounts that do not fit ``decimal(38,0)`` become NULL and the row stays. ``keep_amount``
    carries the exact integer along as ``amount``, so that balances can be decided on it.
    """
    assets = tokens.select(F.col("address").alias("_asset"), "name", "symbol", "decimals")
    exact = try_decimal("value")
    amount = exact.cast("double")
    kept = [exact.alias("amount")] if keep_amount else []
    return transfers.join(assets, F.lower("token_address") == F.col("_asset"), "inner").select(
        "transaction_hash",
        "from_address",
        "to_address",
        (amount / F.pow(F.lit(10.0), F.col("decimals"))).alias("adjusted_value"),
        "block_timestamp",
        "token_address",
        "name",
        "symbol",
        "decimals",
        *kept,
    )


def processed_transfers(normalized: DataFrame) -> DataFrame:
    """The four columns later steps need."""
    return normalized.select("from_address", "to_address", "token_address", "adjusted_value")
