"""Balances kept over slices of transfers.

The state has one row per wallet and asset: the exact sum of all signed amounts so far, their count and the last activity,
also where nothing is left of them.  Sums of slices add up to the sum of everything, so a new slice is summed on its own
and joined with the state; older transfers are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.sources.versions import Buckets, Version, current_version, publish, read_published

KEYS = ("user_address", "token_address")
BUCKETS = 64


def slice_state(flows: DataFrame) -> DataFrame:
    """The state of one slice, from ``portfolio.signed_flows`` with exact amounts. Combines before its shuffle.

    ``amount`` is null only where the sum has more than 38 digits, which lasts; ``n_amounts`` counts what was summed.
    """
    amounts, exact = F.count("amount"), F.try_sum("amount")
    return (
        flows.where(F.col("user_address").isNotNull())
        .groupBy(*KEYS)
        .agg(
            F.when(amounts == 0, F.lit(0).cast("decimal(38,0)")).otherwise(exact).cast("decimal(38,0)").alias("amount"),
            amounts.alias("n_amounts"),
            F.max("decimals").alias("decimals"),
            F.coalesce(F.sum("value"), F.lit(0.0)).alias("balance"),
            F.count(F.lit(1)).alias("tx_count"),
            F.max("block_timestamp").alias("last_active"),
        )
    )


def merged_state(state: DataFrame, later: DataFrame) -> DataFrame:
    """One state from two, by a full join on the keys; rows of either side alone stay as they are."""
    a, b = state.alias("a"), later.alias("b")
    same = [F.col(f"a.{key}") == F.col(f"b.{key}") for key in KEYS]  # flows always name an asset
    here, there = F.col("a.n_amounts").isNotNull(), F.col("b.n_amounts").isNotNull()

    def either(name: str, both: Column) -> Column:
        return F.when(here & there, both).when(here, F.col(f"a.{name}")).otherwise(F.col(f"b.{name}")).alias(name)

    def added(name: str) -> Column:
        return either(name, F.col(f"a.{name}") + F.col(f"b.{name}"))

    total = F.try_add(F.col("a.amount"), F.col("b.amount")).cast("decimal(38,0)")
    return a.join(b, same, "full").select(
        *[F.coalesce(f"a.{key}", f"b.{key}").alias(key) for key in KEYS],
        either("amount", total),
        added("n_amounts"),
        either("decimals", F.greatest("a.decimals", "b.decimals")),
        added("balance"),
        added("tx_count"),
        either("last_active", F.greatest("a.last_active", "b.last_active")),
    )


def held_balances(state: DataFrame) -> DataFrame:
    """Positive balances with activity, the same as ``portfolio.portfolios`` over all transfers of the state."""
    some = F.col("n_amounts") > 0
    exact = F.when(some, F.col("amount"))
    rough = F.when(some, F.col("balance"))
    scaled = exact.cast("double") / F.pow(F.lit(10.0), F.col("decimals"))
    return state.where(F.coalesce(exact > 0, rough > 0)).select(
        *KEYS, F.coalesce(scaled, rough).alias("balance"), "tx_count", "last_active"
    )


def add_slice(root: str, flows: DataFrame, name: str, buckets: int = BUCKETS) -> Version:
    """Add a slice's flows to the state published at ``root`` and return the new version.

    A slice whose ``name`` the state already has changes nothing, so a failed run can be repeated from its first slice.
    The state lies in buckets by wallet and asset: only the slice is exchanged, and a version is written as it was joined.
    """
    spark: SparkSession = flows.sparkSession
    before = current_version(spark, root)
    known = before.notes["slices"] if before else []
    if name in known:
        return before
    notes = {"slices": [*known, name]}
    if before is None:
        return publish(slice_state(flows), root, notes, buckets=Buckets(KEYS, buckets))
    # Pairs are unique by now, so no bucket is heavier than others.
    later = slice_state(flows).repartition(before.buckets.n, *KEYS)
    merged = merged_state(read_published(spark, root), later)
    return publish(merged, root, notes, buckets=before.buckets, arranged=True)
