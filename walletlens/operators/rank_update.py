"""Ranks kept over slices of the transfer graph.

Ranks p are those that ``graph.pagerank`` tends to: p = (1 - damping) + damping * sum(p / out_degree).  The state has, for
each wallet, an estimate of p, its out-degree and its residual: what one more round would add to the estimate.  A new slice
changes residuals only where its edges begin and end.  A wallet whose residual is above the tolerance then takes it into
its estimate and hands ``damping`` times it on to its receivers, until no residual is above the tolerance.  Only wallets
reached so travel; the state and the edges stay where they are.

Every residual ends within the tolerance, so the sum of all errors is at most wallets * tolerance / (1 - damping).  A push
takes at least (1 - damping) of what it moves out of the residuals' sum, so the rounds come to an end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import discard, written
from walletlens.operators.graph import DAMPING
from walletlens.sources.versions import Buckets, Version, current_version, publish, read_folders, read_published

BUCKETS = 64
TOLERANCE = 1e-3
# Edges of a sender that lie in one bucket; a sender with more has several pieces, each in a bucket of its own.
PIECE_EDGES = 1_000_000
STATE = "id long, pagerank double, residual double, out_degree long"


def _pieces(degree: Column, piece_edges: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(degree / piece_edges)).cast("long")


def _old_state(spark: SparkSession, root: str) -> DataFrame:
    return read_published(spark, f"{root}/state") if current_version(spark, f"{root}/state") else (
        spark.createDataFrame([], STATE)
    )


def _outgoing(senders: DataFrame, parts: list[DataFrame], degree: str, piece_edges: int) -> DataFrame:
    """``senders`` (src, ...) with ``dst`` of each of their edges in ``parts``, which are not exchanged.

    Degrees never fall, so the pieces of today's degree include those that older edges were dealt to.
    """
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), _pieces(F.col(degree), piece_edges) - 1))
    asked = senders.withColumn("piece", pieces)
    found = None
    for part in parts:
        one = part.join(asked, ["src", "piece"])
        found = one if found is None else found.unionByName(one)
    return found


def _stored_edges(root: str, slice_edges: DataFrame, name: str, buckets: int, piece_edges: int) -> Version:
    """Append the edges of a slice that are not stored yet, unless a failed run has done so already."""
    spark = slice_edges.sparkSession
    before = current_version(spark, f"{root}/edges")
    if before and name in before.notes["slices"]:
        return before
    asked = written(slice_edges.select("src", "dst").where("src <> dst").distinct(), "slice-edges")
    degrees = _old_state(spark, root).select(F.col("id").alias("src"), "out_degree")
    senders = asked.select("src").distinct().join(degrees, "src", "left").fillna(0, ["out_degree"])
    new = asked
    if before:
        known = _outgoing(senders, read_folders(spark, before), "out_degree", piece_edges)
        new = asked.join(known.select("src", "dst"), ["src", "dst"], "left_anti")
    new = written(new, "new-edges")
    grown = new.groupBy("src").agg(F.count(F.lit(1)).alias("added")).join(degrees, "src", "left")
    total = grown.select("src", (F.col("added") + F.coalesce("out_degree", F.lit(0))).alias("total"))
    piece = F.pmod(F.xxhash64("dst"), _pieces(F.col("total"), piece_edges)).cast("long")
    dealt = new.join(total, "src").select("src", piece.alias("piece"), "dst")
    notes = {"slices": [*(before.notes["slices"] if before else []), name]}
    keys = before.buckets if before else Buckets(("src", "piece"), buckets)
    version = publish(dealt, f"{root}/edges", notes, append=True, buckets=keys)
    discard(new)
    discard(asked)
    return version


def _reached(spark: SparkSession, root: str, edges: Version, damping: float, piece_edges: int) -> DataFrame:
    """State of the wallets whose residual the last slice changes, with that change."""
    *older, newest = read_folders(spark, edges)
    state = _old_state(spark, root)
    added = newest.groupBy("src").agg(F.count(F.lit(1)).alias("added"))
    was = state.select(F.col("id").alias("src"), "pagerank", F.col("out_degree").alias("was"))
    senders = written(
        added.join(was, "src", "left")
        .fillna(0, ["pagerank", "was"])
        .select("src", "pagerank", "was", (F.col("was") + F.col("added")).alias("now")),
        "senders",
    )
    gain = F.lit(damping) * F.col("pagerank") / F.col("now")
    ends = F.array(
        F.struct(F.col("src").alias("id"), F.lit(0.0).alias("gain"), F.lit(1).cast("long").alias("added")),
        F.struct(F.col("dst").alias("id"), gain.alias("gain"), F.lit(0).cast("long").alias("added")),
    )
    changes = newest.join(senders, "src").select(F.inline(ends))
    if older:
        # Each older receiver of these senders gets a smaller share than before.
        less = gain - F.lit(damping) * F.col("pagerank") / F.col("was")
        shared = _outgoing(senders.where("was > 0"), older, "was", piece_edges)
        changes = changes.unionByName(
            shared.select(F.col("dst").alias("id"), less.alias("gain"), F.lit(0).cast("long").alias("added"))
        )
    total = changes.groupBy("id").agg(F.sum("gain").alias("gain"), F.sum("added").alias("added"))
    # A wallet without a state is new: its estimate is 0 and one round would make it 1 - damping.
    return total.join(state, "id", "left").select(
        "id",
        F.coalesce("pagerank", F.lit(0.0)).alias("pagerank"),
        (F.coalesce("residual", F.lit(1.0 - damping)) + F.col("gain")).alias("residual"),
        (F.coalesce("out_degree", F.lit(0)) + F.col("added")).cast("long").alias("out_degree"),
    )


def add_edges(
    root: str,
    slice_edges: DataFrame,
    name: str,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    buckets: int = BUCKETS,
    piece_edges: int = PIECE_EDGES,
) -> Version:
    """Add the edges (src, dst) of a slice to the ranks kept at ``root`` and return the state's new version. Runs jobs.

    Edges may repeat each other or stored ones; self transfers and null ends drop out. A slice whose ``name`` the state
    already has changes nothing; after a failed run the same call goes on. The version's notes tell ``rounds`` and
    ``pushed``, the residuals handed on. ``damping`` and ``piece_edges`` must stay the same over all slices.
    """
    spark: SparkSession = slice_edges.sparkSession
    before = current_version(spark, f"{root}/state")
    done = before.notes["slices"] if before else []
    if name in done:
        return before
    edges = _stored_edges(root, slice_edges, name, buckets, piece_edges)
    parts, state = read_folders(spark, edges), _old_state(spark, root)
    reached = written(_reached(spark, root, edges, damping, piece_edges), "reached")
    high = F.abs("residual") > tolerance
    rounds = pushed = 0
    while moving := reached.where(high).count():
        rounds, pushed = rounds + 1, pushed + moving
        senders = reached.where(high & (F.col("out_degree") > 0)).select(
            F.col("id").alias("src"), "out_degree", (F.col("residual") * damping / F.col("out_degree")).alias("share")
        )
        handed = written(
            _outgoing(senders, parts, "out_degree", piece_edges)
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum("share").alias("residual")),
            "handed",
        )
        settled = reached.select(
            "id",
            F.when(high, F.col("pagerank") + F.col("residual")).otherwise(F.col("pagerank")).alias("pagerank"),
            F.when(high, F.lit(0.0)).otherwise(F.col("residual")).alias("residual"),
            "out_degree",
        )
        first_reached = handed.join(reached, "id", "left_anti").select("id")
        rows = settled.unionByName(state.join(first_reached, "id")).unionByName(
            handed.select("id", F.lit(0.0).alias("pagerank"), "residual", F.lit(0).cast("long").alias("out_degree"))
        )
        sums = [F.sum(column).alias(column) for column in ("pagerank", "residual", "out_degree")]
        last, reached = reached, written(rows.groupBy("id").agg(*sums), "reached")
        discard(last)
        discard(handed)
    notes = {"slices": [*done, name], "rounds": rounds, "pushed": pushed}
    if before is None:
        version = publish(reached, f"{root}/state", notes, buckets=Buckets(("id",), buckets))
    else:
        later = reached.repartition(before.buckets.n, "id").alias("b")
        old = state.alias("a")
        new = F.col("b.pagerank").isNotNull()
        merged = old.join(later, F.col("a.id") == F.col("b.id"), "full").select(
            F.coalesce("a.id", "b.id").alias("id"),
            *[
                F.when(new, F.col(f"b.{column}")).otherwise(F.col(f"a.{column}")).alias(column)
                for column in ("pagerank", "residual", "out_degree")
            ],
        )
        version = publish(merged, f"{root}/state", notes, buckets=before.buckets, arranged=True)
    discard(reached)
    return version


def kept_ranks(spark: SparkSession, root: str) -> DataFrame:
    """(id, pagerank) of every wallet of the slices so far."""
    return read_published(spark, f"{root}/state").select("id", "pagerank")


def compact_edges(spark: SparkSession, root: str) -> Version:
    """The same edges in one folder; worth its one pass after many slices. Not between a failed slice and its repetition."""
    version, state = current_version(spark, f"{root}/edges"), current_version(spark, f"{root}/state")
    if state is None or state.notes["slices"] != version.notes["slices"]:
        raise ValueError("the last slice of edges is not in the ranks yet")
    return publish(read_published(spark, f"{root}/edges"), f"{root}/edges", version.notes, buckets=version.buckets)


def settled(ranks: DataFrame, edge_list: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, out_degree, is_settled) of every wallet of ``edge_list``: does one whole round change its rank by at most ``tolerance``?

    A check of ``ranks`` that knows nothing of how they were found.
    """
    degrees = edge_list.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))
    shares = degrees.join(ranks.withColumnRenamed("id", "src"), "src").select(
        "src", (F.col("pagerank") / F.col("out_degree")).alias("share")
    )
    received = edge_list.join(shares, "src").groupBy(F.col("dst").alias("id")).agg(F.sum("share").alias("received"))
    wallets = edge_list.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    once_more = F.lit(1.0 - damping) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    # A thousandth of the tolerance for what rounding adds up to.
    near = F.abs(once_more - F.col("pagerank")) <= tolerance * 1.001
    return (
        wallets.join(received, "id", "left")
        .join(ranks, "id", "left")
        .join(degrees.withColumnRenamed("src", "id"), "id", "left")
        .select("id", F.coalesce("out_degree", F.lit(0)).alias("out_degree"), F.coalesce(near, F.lit(False)).alias("is_settled"))
    )
