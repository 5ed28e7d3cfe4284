"""Global order without a single-partition window.

A window with an ``orderBy`` and no ``partitionBy`` sends every row to one task. Here the
rows are range-partitioned, stored once (so both passes see the same ranges), and each
range is shifted by what lies before it. Only one total per range is ever brought together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written

# monotonically_increasing_id() keeps the partition number above bit 33.
_POSITION_BITS = 33


def _before(column: str) -> Column:
    # One row per range partition reaches this window, never the data itself.
    frame = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(frame), F.lit(0))


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], out: str, start: int = 1
) -> DataFrame:
    """Add consecutive ids in the order of ``order_by``, which must be unique per row."""
    stored = written(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_range", F.shiftright("_position", _POSITION_BITS))
    offsets = (
        stored.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", _before("_rows").alias("_before"))
    )
    in_range = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return stored.join(F.broadcast(offsets), "_range").select(
        *df.columns, (F.col("_before") + in_range + F.lit(start)).alias(out)
    )


def running_totals(
    df: DataFrame, order_by: Sequence[str | Column], totals: Mapping[str, str]
) -> DataFrame:
    """Add inclusive running sums ``{output: column}`` in the order of ``order_by``.

    ``order_by`` must be unique per row, so ranges can be split anywhere.
    """
    stored = written(
        df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    per_range = stored.groupBy("_range").agg(
        *[F.sum(column).alias(f"_sum_{out}") for out, column in totals.items()]
    )
    offsets = per_range.select(
        "_range", *[_before(f"_sum_{out}").alias(f"_before_{out}") for out in totals]
    )
    frame = (
        Window.partitionBy("_range")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return stored.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[
            (F.col(f"_before_{out}") + F.sum(column).over(frame)).alias(out)
            for out, column in totals.items()
        ],
    )


def exact_quantile(df: DataFrame, column: str, q: float, out: str) -> DataFrame:
    """One row: the smallest value with at least a share ``q`` of the rows at or below it."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(out))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    ranked = running_totals(counts, [out], {"_up_to": "_rows"})
    everything = ranked.agg(F.sum("_rows")).scalar()
    # A decimal share keeps the rank exact: 0.95 of 20 rows are 19, not a double nearby.
    share = F.lit(Decimal(str(q)))
    return ranked.filter(F.col("_up_to") >= share * everything).agg(F.min(out).alias(out))
