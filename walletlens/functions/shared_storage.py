"""Stage tables in the folder every executor can reach.

Lineage is cut by writing a Parquet table and reading it back.  The table outlives
any executor, and Catalyst then plans with its true size instead of an estimate, so
the planner's own broadcast threshold becomes a check against measured bytes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; only local mode may fall back to a temp dir."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(root)
        return root
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="walletlens-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str = "stage") -> str:
    """A fresh path below the shared folder; one application's paths lie together."""
    application = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/walletlens/{application}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return the stored table. Runs a job."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table from ``written`` that no later job reads. What it served must be stored by now."""
    files = table.inputFiles()
    if files:
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getParent().getParent().getName() == "walletlens":
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def broadcast_if_at_most(df: DataFrame, max_rows: int) -> DataFrame:
    """Write ``df``; hint a broadcast only if the stored row count is within ``max_rows``.

    Beyond the limit the plain table is returned and the join shuffles. Runs a job.
    """
    table = written(df, "side")
    return F.broadcast(table) if table.count() <= max_rows else table
