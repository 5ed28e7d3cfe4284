"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# A word is a run of bytes other than space and \t \n \v \f \r; bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def row_key() -> Column:
    """What tells rows apart: id and hash of the text, null ids equal to each other. Orders by id, null first."""
    return F.struct("doc_id", F.xxhash64("text").alias("text_hash"))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def stage_store() -> dict:
    """A dictionary for the tasks that one worker runs of one stage; the first task of another stage empties it."""
    store = sys.modules.setdefault("_walletlens_store", ModuleType("_walletlens_store"))
    task = TaskContext.get()
    stage = None if task is None else task.stageId()
    if not hasattr(store, "held") or store.stage != stage:
        store.stage, store.held = stage, {}
        pa.default_memory_pool().release_unused()
    return store.held


def per_text(function: Callable[[str], tuple], schema: str) -> Callable[[str], Column]:
    """A column of structs made by ``function`` from each text; null counts as empty."""
    names = [part.split()[0] for part in schema.split(",")]

    @pandas_udf(schema)
    def mapped(texts: pd.Series) -> pd.DataFrame:
        stage_store()  # lets go of what other stages kept
        rows = [function(t if isinstance(t, str) else "") for t in texts]
        return pd.DataFrame(rows, columns=names)

    return mapped


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a generator of column dictionaries."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        stage_store()  # lets go of what other stages kept
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, spark_schema)


def by_bytes(batch: pa.RecordBatch, column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in ``column`` have about ``most`` bytes at most; a longer text stands alone."""
    sizes = np.array(pa.compute.binary_length(batch.column(column)).fill_null(0), np.int64)
    at = 0
    while at < batch.num_rows:
        inside = np.searchsorted(np.cumsum(sizes[at : at + 4096]), most, side="right")
        yield batch.slice(at, max(1, int(inside)))
        at += max(1, int(inside))


def bit_filter(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A packed bit table of fixed size; a value whose bit is off is not among ``values``.

    It only spares rows a shuffle: an exact join follows. Past its size it lets more rows through,
    at last all of them, which costs the shuffle it would have spared and changes no result.
    """
    words = (
        values.select(F.pmod(F.col(column), F.lit(bits)).alias("slot"))
        .select(F.floor(F.col("slot") / 64).alias("w"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
    )
    table = np.zeros(bits // 64, np.int64)
    for batch in words.toArrow().to_batches():  # at most bits / 64 rows
        table[batch.column("w").to_numpy()] = batch.column("b").to_numpy()
    return table.view(np.uint8)


def bits_on(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    slots = values.astype(np.int64) % (len(table) * 8)
    return (table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def maybe_in(table: np.ndarray) -> Callable[[str], Column]:
    """A boolean column: the value may be among those of ``bit_filter``."""

    @pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(bits_on(table, values.to_numpy()))

    return test


def in_fold(doc_id: Column, folds: int = 5) -> Column:
    """The remainder of crc32 of the id as text; a null id falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))
