"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hub wallets and popular assets make heavy join keys: split them even where the
    # split costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Asset lists and maps of this size are cheaper to send than to shuffle all transfers for.
# Stored stages are compared with it by their measured size.
BROADCAST_LIMIT = "100MB"
# A few columns of keys grow some eighty times from their share of a Parquet file to a hash table, and several tables may
# be built at once: a driver with less heap than this takes tables up to a share of its heap only; larger ones are shuffled.
FULL_LIMIT_HEAP = 5 << 30
HEAP_SHARE = 1024
_BROADCAST_KEY = "spark.sql.autoBroadcastJoinThreshold"
_SPARK_DEFAULT = "10485760b"


def driver_heap(spark: SparkSession) -> int:
    """Bytes that the driver's JVM may fill."""
    return spark._jvm.java.lang.Runtime.getRuntime().maxMemory()


def broadcast_limit(heap: int) -> str:
    """The broadcast limit of a driver with ``heap`` bytes."""
    return BROADCAST_LIMIT if heap >= FULL_LIMIT_HEAP else f"{heap // HEAP_SHARE}b"


def bound_broadcasts(spark: SparkSession) -> None:
    """Lower Spark's default broadcast limit where the driver's heap is small; one that the cluster has set stays."""
    heap = driver_heap(spark)
    if heap < FULL_LIMIT_HEAP and spark.conf.get(_BROADCAST_KEY) == _SPARK_DEFAULT:
        spark.conf.set(_BROADCAST_KEY, broadcast_limit(heap))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on.

    Partition numbers and sizes stay the cluster's choice, and so does a broadcast limit it
    has set itself.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get(_BROADCAST_KEY) == _SPARK_DEFAULT:
        spark.conf.set(_BROADCAST_KEY, broadcast_limit(driver_heap(spark)))
    return spark


def local_session(
    cores: int | str = "*",
    memory: str = "8g",
    partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("walletlens")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
