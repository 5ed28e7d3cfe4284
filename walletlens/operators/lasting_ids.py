"""Dense ids that stay what they are when keys are added.

A dictionary is published and only ever appended to: an id once given is never changed, and new keys are numbered behind
the last one in ascending order.  Ids are 1 to the number of keys after every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.functions.ordering import number_rows
from walletlens.functions.shared_storage import written
from walletlens.sources.versions import Buckets, Version, current_version, publish, read_folders, read_published

BUCKETS = 64


def extend_ids(root: str, keys: DataFrame, key: str, out: str, buckets: int = BUCKETS) -> Version:
    """Give an id to every key of ``keys`` that the dictionary at ``root`` does not have, and return its version.

    ``keys`` may repeat keys and hold null, which gets no id. Without new keys nothing is published. The dictionary lies in
    buckets by key: the new slice's keys are exchanged once and compared with each part of the dictionary in place.
    """
    spark: SparkSession = keys.sparkSession
    before = current_version(spark, root)
    asked = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if before is not None:
        asked = asked.repartition(before.buckets.n, key)
        for part in read_folders(spark, before):
            asked = asked.join(part.select(key), key, "left_anti")
    new = written(asked, "new-keys")
    last = before.notes["last_id"] if before else 0
    n = new.count()
    if before is not None and not n:
        return before
    numbered = number_rows(new, [key], out, start=last + 1).withColumn(out, F.col(out).cast("long"))
    return publish(
        numbered, root, {"last_id": last + n}, append=True, buckets=Buckets((key,), before.buckets.n if before else buckets)
    )


def id_map(spark: SparkSession, root: str) -> DataFrame:
    """The whole dictionary as (key, id)."""
    return read_published(spark, root)


def compact_ids(spark: SparkSession, root: str) -> Version:
    """The same dictionary in one folder; worth its one pass after many appended slices."""
    version = current_version(spark, root)
    return publish(read_published(spark, root), root, version.notes, buckets=version.buckets)
