"""Tables that are published version by version.

``mode("overwrite")`` deletes a table before its successor is whole.  Here a version is written to a folder of its own and
then named by a small numbered file; the largest number is the table.  A reader during a write, or after a failed one,
sees the version before.  A version may add a folder to those of its predecessor, so appending rewrites nothing.
One writer at a time; readers as many as like.

A version can be bucketed: its rows lie in as many files as it has buckets, by hash of its keys, and a join on those keys
needs no exchange of them.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from walletlens.functions.files import Store

VERSIONS_KEPT = 2


@dataclass(frozen=True)
class Buckets:
    keys: tuple[str, ...]
    n: int


@dataclass(frozen=True)
class Version:
    """A published table: its folders, schema, buckets, and notes of the writer (any JSON)."""

    number: int
    root: str
    folders: list[str]
    schema: StructType
    buckets: Buckets | None = None
    notes: dict = field(default_factory=dict)


def _markers(store: Store, root: str) -> list[int]:
    return sorted(int(name) for name in store.names(f"{root}/_versions") if re.fullmatch(r"\d{10}", name))


def _load(store: Store, root: str, number: int) -> Version:
    told = json.loads(store.read(f"{root}/_versions/{number:010d}"))
    buckets = Buckets(tuple(told["buckets"][0]), told["buckets"][1]) if told["buckets"] else None
    return Version(number, root, told["folders"], StructType.fromJson(told["schema"]), buckets, told["notes"])


def current_version(spark: SparkSession, root: str) -> Version | None:
    """The last published version; None before the first."""
    store = Store(spark, root)
    numbers = _markers(store, root)
    return _load(store, root, numbers[-1]) if numbers else None


def _table_name(path: str) -> str:
    return f"published_{hashlib.md5(path.encode()).hexdigest()}"


def read_folders(spark: SparkSession, version: Version) -> list[DataFrame]:
    """One table per folder of a version, with its buckets where it has any."""
    paths = [f"{version.root}/{folder}" for folder in version.folders]
    if version.buckets is None:
        return [spark.read.schema(version.schema).parquet(path) for path in paths]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema)
    keys = ", ".join(f"`{key}`" for key in version.buckets.keys)
    for path in paths:
        # Another session's catalog may not know the folder yet.
        spark.sql(
            f"create table if not exists {_table_name(path)} ({columns}) using parquet "
            f"clustered by ({keys}) sorted by ({keys}) into {version.buckets.n} buckets location '{path}'"
        )
    return [spark.table(_table_name(path)) for path in paths]


def read_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of the current version, or of one that is still kept."""
    version = current_version(spark, root) if number is None else _load(Store(spark, root), root, number)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    first, *others = read_folders(spark, version)
    for other in others:
        first = first.unionByName(other)
    return first


def publish(
    df: DataFrame,
    root: str,
    notes: dict | None = None,
    append: bool = False,
    buckets: Buckets | None = None,
    arranged: bool = False,
    kept: int = VERSIONS_KEPT,
) -> Version:
    """Write ``df`` as the next version of the table at ``root`` and return it.

    ``append`` adds the rows to those of the current version, whose schema and buckets they must have. ``arranged`` says
    that tasks already hold whole buckets, as after a join of bucketed tables; otherwise rows are dealt to them here.
    The last ``kept`` versions can still be read; what no kept version names is deleted, remains of failed writes included.
    """
    spark, store = df.sparkSession, Store(df.sparkSession, root)
    before = current_version(spark, root)
    if append and before is not None:
        if before.buckets != buckets or [f.name for f in before.schema] != df.columns:
            raise ValueError("appended rows must have the columns and buckets of the table")
    folder = f"data-{uuid.uuid4().hex}"
    path = f"{root}/{folder}"
    if buckets is None:
        df.write.parquet(path)
    else:
        rows = df if arranged else df.repartition(buckets.n, *buckets.keys)
        writer = rows.write.format("parquet").option("path", path)
        writer.bucketBy(buckets.n, *buckets.keys).sortBy(*buckets.keys).saveAsTable(_table_name(path))
    number = before.number + 1 if before else 1
    folders = [*(before.folders if append and before else []), folder]
    told = {
        "folders": folders, "schema": df.schema.jsonValue(), "notes": notes or {},
        "buckets": [list(buckets.keys), buckets.n] if buckets else None,
    }
    store.create(f"{root}/_versions/{number:010d}", json.dumps(told))
    _clean(spark, store, root, kept)
    return _load(store, root, number)


def _clean(spark: SparkSession, store: Store, root: str, kept: int) -> None:
    numbers = _markers(store, root)
    for number in numbers[:-kept]:
        store.delete(f"{root}/_versions/{number:010d}")
    named: set[str] = set()
    for number in numbers[-kept:]:
        named |= set(_load(store, root, number).folders)
    for folder in store.names(root):
        if folder.startswith("data-") and folder not in named:
            spark.sql(f"drop table if exists {_table_name(f'{root}/{folder}')}")
            store.delete(f"{root}/{folder}")


def unpublish(spark: SparkSession, root: str) -> None:
    """Delete a published table with all its versions."""
    store = Store(spark, root)
    for folder in store.names(root):
        if folder.startswith("data-"):
            spark.sql(f"drop table if exists {_table_name(f'{root}/{folder}')}")
    store.delete(root)
