"""Readers and writers for stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Quoting of the asset CSV.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_slices(
    spark: SparkSession, paths: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """Several Parquet slices as one table. A declared schema saves footer inference."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def read_first_available(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The first path that exists. Any other failure is raised, not skipped."""
    for path in paths:
        try:
            return spark.read.format(fmt).options(**(options or {})).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these paths exists: {', '.join(paths)}")


def read_token_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Asset CSV with a header; quoted line breaks and doubled quotes; all columns are text.

    A CSV with line breaks inside quotes cannot be split within a file: write many files.
    """
    return spark.read.options(**CSV_OPTIONS, multiLine="true").csv(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    n_files: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Overwrite ``path``; ``n_files`` spreads the rows evenly over that many files."""
    rows = df if n_files is None else df.repartition(n_files)
    writer = rows.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)


def save_catalog_table(
    df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None
) -> DataFrame:
    """Overwrite a catalog table and return it as read back from the catalog.

    Without ``path`` the catalog manages the files. ``fmt`` takes any installed format.
    """
    writer = df.write.mode("overwrite").format(fmt)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)
