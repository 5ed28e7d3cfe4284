"""Raw slices kept by day: a rerun replaces its own days, and a reader opens only the days it asks for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from walletlens.functions.files import Store
from walletlens.sources.extracts import within

DAY = "day"


def _dates(start: str | dt.date, end: str | dt.date) -> tuple[dt.date, dt.date]:
    first, last = (dt.date.fromisoformat(str(day)) for day in (start, end))
    if first >= last:
        raise ValueError(f"no days from {first} to {last}")
    return first, last


def write_days(
    df: DataFrame, path: str, start: str | dt.date, end: str | dt.date, column: str = "block_timestamp"
) -> list[dt.date]:
    """Make ``df`` the content of the days from ``start`` up to ``end`` at ``path``; returns the days that have rows.

    Days outside the range stay as they are, and rows outside are left out. A day of the range that has no rows any more goes.
    Each day's files are exchanged when all of them are whole. A day is dealt to as many tasks as its size needs, so
    neither many small files nor one task for a busy day arise. ``df`` is read twice.
    """
    spark = df.sparkSession
    first, last = _dates(start, end)
    rows = df.where(within(first, last, column)).withColumn(DAY, F.to_date(column))
    found = sorted(r[0] for r in rows.select(DAY).distinct().collect())  # at most the days of the range
    writer = rows.hint("rebalance", DAY).write.partitionBy(DAY).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    store, kept = Store(spark, path), {f"{DAY}={day.isoformat()}" for day in found}
    for name in store.names(path):
        if name.startswith(f"{DAY}=") and name not in kept:
            if first <= dt.date.fromisoformat(name.removeprefix(f"{DAY}=")) < last:
                store.delete(f"{path}/{name}")
    return found


def read_days(
    spark: SparkSession, path: str, schema: StructType, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """The rows of the days from ``start`` up to ``end`` (``schema`` is that of the rows; ``day`` comes along).

    The range is a condition on folders, so other days are neither listed by tasks nor opened.
    """
    first, last = _dates(start, end)
    whole = StructType([*schema.fields, StructField(DAY, DateType())])
    days = spark.read.schema(whole).parquet(path)
    return days.where((F.col(DAY) >= F.lit(first)) & (F.col(DAY) < F.lit(last)))
