"""Per-wallet portfolios, contract labels and the cut of exchange wallets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: wallets with this many transactions or more are taken for exchanges.
EXCHANGE_TX_LIMIT = 5000


def signed_flows(normalized: DataFrame) -> DataFrame:
    """Two rows per transfer: plus at the receiver, minus at the sender, from a single scan.

    The exact ``amount`` and its ``decimals`` come along where ``normalized`` has them.
    """
    exact = "amount" in normalized.columns

    def leg(address: str, sign: int):
        amounts = [(F.col("amount") * sign).cast("decimal(38,0)").alias("amount")] if exact else []
        value = (F.col("adjusted_value") * float(sign)).alias("value")
        return F.struct(F.lower(address).alias("user_address"), value, *amounts)

    rest = ["leg.amount", "decimals"] if exact else []
    return normalized.select(
        F.lower("token_address").alias("token_address"),
        "block_timestamp",
        *(["decimals"] if exact else []),
        F.explode(F.array(leg("to_address", 1), leg("from_address", -1))).alias("leg"),
    ).select("leg.user_address", "token_address", "leg.value", "block_timestamp", *rest)


def portfolios(flows: DataFrame) -> DataFrame:
    """Positive balances by wallet and asset, with activity. Combines before its one shuffle.

    With exact amounts a balance is their sum, scaled at the end: +0.1, +0.2 and -0.3 leave
    nothing, in whatever order rows arrive. A sum over 38 digits falls back to the doubles.
    """
    sums = [
        F.sum("value").alias("balance"),
        F.count(F.lit(1)).alias("tx_count"),
        F.max("block_timestamp").alias("last_active"),
    ]
    exact = "amount" in flows.columns
    if exact:
        sums += [F.try_sum("amount").alias("_exact"), F.max("decimals").alias("_decimals")]
    held = (
        flows.filter(F.col("user_address").isNotNull())
        .groupBy("user_address", "token_address")
        .agg(*sums)
    )
    if exact:
        # All rows of a pair share their asset's decimals.
        scaled = F.col("_exact").cast("double") / F.pow(F.lit(10.0), F.col("_decimals"))
        positive = F.coalesce(F.col("_exact") > 0, F.col("balance") > 0)
        held = held.filter(positive).withColumn("balance", F.coalesce(scaled, F.col("balance")))
        return held.drop("_exact", "_decimals")
    return held.filter(F.col("balance") > 0)


def contract_addresses(contracts: DataFrame) -> DataFrame:
    """Distinct lower-cased contract addresses."""
    return contracts.select(F.lower("address").alias("address")).distinct()


def label_contracts(held: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add ``is_contract``. ``contracts`` must be unique by address.

    Pass a stored contract table: a distinct directly below the join would hide its
    exchange from the adaptive skew split.
    """
    known = contracts.select(F.col("address").alias("_contract"))
    return held.join(known, F.col("user_address") == F.col("_contract"), "left").select(
        *held.columns, F.col("_contract").isNotNull().alias("is_contract")
    )


def label_counts(labelled: DataFrame) -> DataFrame:
    """Portfolio rows in all, of contracts and of ordinary wallets, in one pass."""
    return labelled.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_contract")).alias("contracts"),
        F.count_if(~F.col("is_contract")).alias("eoa_users"),
    )


def wallet_totals(held: DataFrame) -> DataFrame:
    """One row per wallet with its transactions; labels and cuts need no more than this."""
    return held.groupBy("user_address").agg(F.sum("tx_count").alias("tx_count"))


def real_users(labelled: DataFrame, max_tx: int = EXCHANGE_TX_LIMIT) -> DataFrame:
    """Wallets that are neither contracts nor, by activity, exchanges.

    ``labelled`` may hold portfolio rows or, cheaper, labelled ``wallet_totals``: those are
    combined before the label join, so a wallet with very many assets arrives as one row.
    """
    return (
        labelled.filter(~F.col("is_contract"))
        .groupBy("user_address")
        .agg(F.sum("tx_count").alias("total_tx_count"))
        .filter(F.col("total_tx_count") < max_tx)
    )


def real_portfolios(held: DataFrame, users: DataFrame) -> DataFrame:
    """Portfolio rows of ``users`` (see ``real_users``; pass it stored).

    None of these wallets is a contract, so the rows need no label join of their own.
    """
    return held.join(users.select("user_address"), "user_address", "left_semi").withColumn(
        "is_contract", F.lit(False)
    )


def user_activity(held: DataFrame, ordered: bool = False) -> DataFrame:
    """Assets, transactions and rows by wallet; ``ordered`` sorts by assets, most first.

    ``held`` has a row per wallet and asset, so counting rows counts assets.
    """
    activity = held.groupBy("user_address").agg(
        F.count("token_address").alias("token_count"),
        F.sum("tx_count").alias("total_tx_count"),
        F.count(F.lit(1)).alias("portfolio_rows"),
    )
    return activity.orderBy(F.desc("token_count"), "user_address") if ordered else activity
