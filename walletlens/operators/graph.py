"""The transfer graph: PageRank and wallet samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.session import tune

# Fixed values.
ITERATIONS = 5
DAMPING = 0.85
START_RANK = 1.0
TOP_REPORT = 20
TOP_EXPORT = 1000
SAMPLE_TOP = 2000
SAMPLE_MID = 3000
SAMPLE_LOW = 5000
MID_LOWER = 0.8
MID_UPPER = 1.2

# Below this out-degree a wallet is never treated as a hub.
MIN_HUB_DEGREE = 10_000
# Edges of a partition: the graph alone decides how many there are.
EDGES_PER_PARTITION = 100_000
# Rounds between two stored states; bounds the plan and what a lost executor costs.
ROUNDS_PER_STAGE = 3


def edges(indexed_transfers: DataFrame) -> DataFrame:
    """Distinct directed edges; self transfers and unmapped ends drop out."""
    return (
        indexed_transfers.select(
            F.col("from_user_id").alias("src"), F.col("to_user_id").alias("dst")
        )
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )


def wallet_pairs(transfers: DataFrame) -> DataFrame:
    """Distinct address pairs: enough for the graph, and far fewer rows to look ids up for."""
    return transfers.select(
        F.lower("from_address").alias("from_address"), F.lower("to_address").alias("to_address")
    ).distinct()


def _ends(edge_list: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("out")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("out")),
    )
    return edge_list.select(F.explode(ends).alias("end")).select("end.id", "end.out")


def vertices(edge_list: DataFrame) -> DataFrame:
    """Every wallet on an edge."""
    return _ends(edge_list).select("id").distinct()


def out_degrees(edge_list: DataFrame) -> DataFrame:
    """Outgoing edges by wallet, for wallets that have any."""
    return edge_list.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def _graph_session(spark: SparkSession, n_edges: int) -> SparkSession:
    """A session whose shuffles have the graph's number of partitions, so that sums meet edges unmoved.

    The caller's session keeps its settings.
    """
    partitions = max(1, -(-n_edges // EDGES_PER_PARTITION))
    own = spark.newSession()
    tune(own)
    key = "spark.sql.autoBroadcastJoinThreshold"
    own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return own


def pagerank(
    edge_list: DataFrame,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    min_hub_degree: int = MIN_HUB_DEGREE,
    rounds_per_stage: int = ROUNDS_PER_STAGE,
    redistribute_sinks: bool = False,
) -> DataFrame:
    """Fixed rounds of ``1 - damping + damping * sum(rank / out_degree)``. Runs jobs.

    Wallets without an outgoing edge lose their rank and nothing is normalised, unless
    ``redistribute_sinks`` shares what they lose among all wallets.

    Edges are partitioned and sorted by sender once and kept; wallets are partitioned by id
    the same way, so a round shuffles only the contributions, combined per receiver first.
    A sender with more edges than an average partition would overload its task: at most one
    such hub per partition can exist, so their ranks are broadcast to their edges, which
    stay spread as stored. A graph without hubs has an empty table of them in the same plan.
    """
    spark = edge_list.sparkSession
    stored = written(edge_list.select("src", "dst"), "edges")
    n_edges = stored.count()
    own = _graph_session(spark, n_edges)
    stored_edges = own.read.schema(stored.schema).parquet(*stored.inputFiles()) if n_edges else (
        own.createDataFrame([], stored.schema)
    )
    partitions = int(own.conf.get("spark.sql.shuffle.partitions"))
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return df

    try:
        nodes = keep(
            _ends(stored_edges)
            .groupBy("id")
            .agg(F.sum("out").alias("out_degree"))
            .repartition(partitions, "id")
            .sortWithinPartitions("id")
        )
        is_hub = F.col("out_degree") > max(min_hub_degree, n_edges // partitions)
        hubs = nodes.filter(is_hub).select(F.col("id").alias("src"))
        hub_edges = keep(stored_edges.join(F.broadcast(hubs), "src", "left_semi"))
        kept_edges = keep(
            stored_edges.join(F.broadcast(hubs), "src", "left_anti")
            .repartition(partitions, "src")
            .sortWithinPartitions("src")
        )
        state = nodes.select("id", "out_degree", F.lit(START_RANK).alias("pagerank"))
        for done in range(1, iterations + 1):
            shares = state.filter(F.col("out_degree") > 0).select(
                F.col("id").alias("src"),
                "out_degree",
                (F.col("pagerank") / F.col("out_degree")).alias("share"),
            )
            hub_shares = shares.filter(is_hub).select("src", "share")
            parts = (
                kept_edges.join(shares, "src")
                .select("dst", "share")
                .unionByName(hub_edges.join(F.broadcast(hub_shares), "src").select("dst", "share"))
            )
            received = parts.groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("received"))
            inflow = F.coalesce("received", F.lit(0.0))
            if redistribute_sinks:
                lost = state.agg(
                    F.coalesce(F.sum(F.when(F.col("out_degree") == 0, F.col("pagerank"))), F.lit(0.0))
                    / F.count(F.lit(1))
                )
                inflow = inflow + lost.scalar()
            state = nodes.join(received, "id", "left").select(
                "id", "out_degree", (F.lit(1.0 - damping) + F.lit(damping) * inflow).alias("pagerank")
            )
            if done % rounds_per_stage == 0 and done < iterations:
                state = written(state, "ranks")
        ranks = written(state.select("id", "pagerank"), "ranks")
    finally:
        for df in kept:
            df.unpersist()
    files = ranks.inputFiles()
    return spark.read.schema(ranks.schema).parquet(*files) if files else spark.createDataFrame([], ranks.schema)


def top_wallets(ranks: DataFrame, k: int = TOP_REPORT) -> DataFrame:
    """The ``k`` highest ranks; ids break ties."""
    return ranks.orderBy(F.desc("pagerank"), "id").limit(k)


def mid_wallets(
    ranks: DataFrame, lower: float = MID_LOWER, upper: float = MID_UPPER, k: int = SAMPLE_MID
) -> DataFrame:
    """``k`` wallets, by id, with a rank around the mean."""
    mean = ranks.agg(F.avg("pagerank")).scalar()
    return ranks.filter(F.col("pagerank").between(mean * lower, mean * upper)).orderBy("id").limit(k)


def low_wallets(ranks: DataFrame, k: int = SAMPLE_LOW) -> DataFrame:
    """The ``k`` lowest ranks; ids break ties."""
    return ranks.orderBy("pagerank", "id").limit(k)


def stratified_sample(
    ranks: DataFrame, top: int = SAMPLE_TOP, mid: int = SAMPLE_MID, low: int = SAMPLE_LOW
) -> DataFrame:
    """Wallets of the three samples, each once, with the first tier that holds them."""
    tiers = [top_wallets(ranks, top), mid_wallets(ranks, k=mid), low_wallets(ranks, low)]
    rows = [tier.withColumn("_order", F.lit(i)) for i, tier in enumerate(tiers)]
    names = F.array(*[F.lit(name) for name in ("top", "mid", "low")])
    return (
        rows[0]
        .unionByName(rows[1])
        .unionByName(rows[2])
        .groupBy("id", "pagerank")
        .agg(F.min("_order").alias("_order"))
        .select("id", "pagerank", F.get(names, F.col("_order")).alias("tier"))
    )
