"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_decimal(column: str, scale: int = 0) -> Column:
    """Text as ``decimal(38, scale)``; NULL where it does not parse or fit."""
    return F.expr(f"try_cast(`{column}` as decimal(38,{scale}))")


def filled(column: Column) -> Column:
    """Neither NULL nor the empty string."""
    return column.isNotNull() & (column != "")


def date_and_hour(column: str) -> tuple[Column, Column]:
    """The calendar day and hour of a timestamp."""
    return F.to_date(column).alias("date"), F.hour(column).alias("hour")


def sparsity_pct(entries: str, users: str, items: str) -> Column:
    """Empty share of a users x items matrix in percent; 100 for a matrix without cells."""
    cells = F.col(users).cast("double") * F.col(items)
    return F.when(cells > 0, (1.0 - F.col(entries) / cells) * 100.0).otherwise(F.lit(100.0))
