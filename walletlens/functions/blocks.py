"""Numpy work inside tasks: columns of vectors as matrices, and maps over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """A column of float lists, all of ``width``, as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def map_columns(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a generator of dictionaries of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, spark_schema)
