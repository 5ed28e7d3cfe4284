"""How activity is spread over wallets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.ordering import running_totals

# Bins of the histogram, and the marked points of the Pareto curve.
HISTOGRAM_BINS = 50
TOP_USER_SHARE = 0.01
TX_SHARE = 0.8


def activity_histogram(
    activity: DataFrame, column: str = "total_tx_count", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Wallets in equal-width bins; the last bin is closed and empty bins are kept.

    A single value gets a range of width one around it.
    """
    edges = activity.agg(
        F.min(column).cast("double").alias("smallest"), F.max(column).cast("double").alias("largest")
    ).select(
        F.struct(
            F.when(F.col("smallest") == F.col("largest"), F.col("smallest") - 0.5)
            .otherwise(F.col("smallest"))
            .alias("lo"),
            F.when(F.col("smallest") == F.col("largest"), F.col("largest") + 0.5)
            .otherwise(F.col("largest"))
            .alias("hi"),
        )
    )
    lo, hi = edges.scalar()["lo"], edges.scalar()["hi"]
    position = F.floor((F.col(column) - lo) * bins / (hi - lo))
    counted = (
        activity.select(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("users"))
    )
    width = (hi - lo) / bins
    every_bin = activity.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lower_edge"),
        (lo + (F.col("bin") + 1) * width).alias("upper_edge"),
        F.coalesce("users", F.lit(0)).alias("users"),
    )


def pareto_curve(activity: DataFrame, column: str = "total_tx_count") -> DataFrame:
    """Cumulative share of transactions against share of wallets, busiest first.

    One row per distinct activity value: wallets with equal activity lie on a straight
    line, so the block ends carry the whole curve.
    """
    blocks = (
        activity.groupBy(F.col(column).alias("tx_value"))
        .agg(F.count(F.lit(1)).alias("users"))
        .withColumn("tx", F.col("tx_value") * F.col("users"))
    )
    curve = running_totals(
        blocks, [F.desc("tx_value")], {"cum_users": "users", "cum_tx": "tx"}
    )
    totals = curve.agg(F.struct(F.sum("users").alias("users"), F.sum("tx").alias("tx")))
    return curve.select(
        "tx_value",
        "users",
        "cum_users",
        "cum_tx",
        (F.col("cum_users") / totals.scalar()["users"]).alias("user_share"),
        (F.col("cum_tx") / totals.scalar()["tx"]).alias("tx_share"),
    )


def pareto_points(
    curve: DataFrame, top: float = TOP_USER_SHARE, share: float = TX_SHARE
) -> DataFrame:
    """One row: transactions of the ``top`` wallets, and wallets behind ``share`` of them."""
    block_users = F.col("user_share") * F.col("users") / F.col("cum_users")
    block_tx = F.col("tx_share") * F.col("users") * F.col("tx_value") / F.col("cum_tx")
    into_users = (F.lit(top) - (F.col("user_share") - block_users)) / block_users
    into_tx = (F.lit(share) - (F.col("tx_share") - block_tx)) / block_tx
    at_top = F.col("tx_share") - block_tx + into_users * block_tx
    at_share = F.col("user_share") - block_users + into_tx * block_users
    first = F.when(F.col("user_share") >= top, F.struct("cum_users", at_top.alias("value")))
    reached = F.when(F.col("tx_share") >= share, F.struct("cum_users", at_share.alias("value")))
    return curve.agg(F.min(first).alias("first"), F.min(reached).alias("reached")).select(
        F.lit(top).alias("top_users"),
        F.col("first.value").alias("tx_share_of_top"),
        F.lit(share).alias("tx_share"),
        F.col("reached.value").alias("users_for_share"),
    )
