"""Gas price statistics by hour."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.columns import date_and_hour
from walletlens.functions.ordering import exact_quantile
from walletlens.functions.shared_storage import broadcast_if_at_most

# The share of prices kept, and the tolerated rank error of the cut.
KEPT_SHARE = 0.95
RANK_ERROR = 0.01
# Numbers a sketch keeps on its largest level; 200 give a rank error of 1.33 %, and 400 of 0.7 %.
SKETCH_K = 400
# About 100 years of hours.
MAX_BROADCAST_HOURS = 1_000_000


def user_gas_hourly(transactions: DataFrame, held: DataFrame, ordered: bool = False) -> DataFrame:
    """Mean gas price by wallet, day and hour, for the wallets of ``held``.

    Aggregating first leaves at most one row per wallet and hour for the join, so neither
    raw transactions nor a busy sender are shuffled row by row.
    """
    hourly = (
        transactions.select(
            F.lower("from_address").alias("user_address"),
            *date_and_hour("block_timestamp"),
            F.col("gas_price").cast("double").alias("gas_price"),
        )
        .groupBy("user_address", "date", "hour")
        .agg(F.avg("gas_price").alias("avg_gas_price"))
    )
    users = held.select(F.lower("user_address").alias("user_address")).distinct()
    result = hourly.join(users, "user_address", "left_semi")
    return result.orderBy("user_address", "date", "hour") if ordered else result


def gas_samples(transactions: DataFrame) -> DataFrame:
    """Timestamps and prices where both are known."""
    return transactions.select(
        "block_timestamp", F.col("gas_price").cast("double").alias("gas_price")
    ).dropna()


def gas_cutoff(
    transactions: DataFrame, q: float = KEPT_SHARE, rel_err: float = RANK_ERROR
) -> DataFrame:
    """One row, ``cutoff``: the ``q`` quantile of all prices.

    ``rel_err`` is the rank error of a mergeable sketch; 0 asks for the exact value, found by
    distributed running counts over the distinct prices.
    """
    samples = gas_samples(transactions)
    if rel_err == 0:
        return exact_quantile(samples, "gas_price", q, "cutoff")
    accuracy = math.ceil(1 / rel_err)
    return samples.agg(F.percentile_approx("gas_price", q, accuracy).alias("cutoff"))


def gas_sketches(transactions: DataFrame, accuracy: int = SKETCH_K) -> DataFrame:
    """One mergeable sketch of prices per day: (date, samples, sketch).

    A day's sketch has some thousand numbers whatever the day, so cuts over many slices never read their prices again;
    a new slice only adds its own rows.
    """
    return (
        gas_samples(transactions)
        .groupBy(F.to_date("block_timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.kll_sketch_agg_double("gas_price", F.lit(accuracy)).alias("sketch"),
        )
    )


def sketched_cutoff(sketches: DataFrame, q: float = KEPT_SHARE) -> DataFrame:
    """One row, ``cutoff`` and ``samples``: the ``q`` quantile of all prices in the sketches, by their merge.

    Its rank is off by one percent of the samples at most, with a probability of 99 %; no sketch gives null.
    """
    merged = sketches.agg(F.sum("samples").alias("samples"), F.kll_merge_agg_double("sketch").alias("sketch"))
    found = F.when(F.col("samples") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))))
    return merged.select(found.alias("cutoff"), F.coalesce("samples", F.lit(0)).alias("samples"))


def gas_baseline_hourly(
    transactions: DataFrame,
    q: float = KEPT_SHARE,
    rel_err: float = RANK_ERROR,
    scope: str = "global",
    ordered: bool = False,
) -> DataFrame:
    """Median price and sample count by hour, without the dearest ``1 - q`` of the prices.

    ``scope`` is "global" (one cut over everything) or "hour" (a cut within each hour).
    """
    samples = gas_samples(transactions).select(*date_and_hour("block_timestamp"), "gas_price")
    if scope == "global":
        cutoff = gas_cutoff(transactions, q, rel_err).scalar()
        kept = samples.filter(F.col("gas_price") <= cutoff)
    elif scope == "hour":
        cuts = samples.groupBy("date", "hour").agg(
            F.percentile_approx("gas_price", q).alias("cutoff")
        )
        # Few keys and many rows: shuffling the samples by hour would use few tasks.
        side = broadcast_if_at_most(cuts, MAX_BROADCAST_HOURS)
        kept = samples.join(side, ["date", "hour"]).filter(
            F.col("gas_price") <= F.col("cutoff")
        )
    else:
        raise ValueError(f"unknown scope: {scope}")
    baseline = kept.groupBy("date", "hour").agg(
        F.percentile_approx("gas_price", 0.5).alias("baseline_gas_price"),
        F.count(F.lit(1)).alias("n_samples"),
    )
    return baseline.orderBy("date", "hour") if ordered else baseline
