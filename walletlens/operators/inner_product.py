"""Exact search for the largest inner products.

Items are numbered by falling length of their vectors and cut into blocks of fixed size.  No product exceeds the two
lengths multiplied, so a query that has ``k`` products above its own length times the next item's length is done.  A
round scans one block for the queries that are still open; most need the first block only, and all of them
the same exact answer as a scan of everything.

A round is one shuffle of rows to slices of queries: first the block's items, then by query what it must not get back
and the query itself.  A task holds one block and a batch of queries, whatever a query excludes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.blocks import map_columns, matrix_of
from walletlens.functions.ordering import number_rows
from walletlens.functions.shared_storage import scratch_path, written

BLOCK_ITEMS = 65_536
STEP_ITEMS = 256
BATCH_QUERIES = 2_048
# Products in one task at most, before any is spared, and where more than one task pays.
SLICE_PRODUCTS = 500_000_000
LEAST_PRODUCTS = 1_000_000
LEAST_SLICES = 8
# Lengths and products are sums of rounded doubles; a bound has to hold for those as well.
SLACK = 1e-9

_ITEM, _HELD, _QUERY = 0, 1, 2


def ordered_items(items: DataFrame) -> DataFrame:
    """``items`` (id, features) with ``length`` and ``place`` from 0 by falling length, then id. Runs jobs."""
    square = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    return number_rows(items.select("id", "features", F.sqrt(square).alias("length")), [F.desc("length"), "id"], "place", 0)


class _Block:
    """The items of a block as they arrive, then searched in steps of falling length."""

    def __init__(self, k: int, next_length: float):
        self.k, self.next_length = k, next_length
        self.ids: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.first_place = None
        self.ready = False

    def add(self, places: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        if self.first_place is None:
            self.first_place = int(places[0])
        self.ids.append(ids)
        self.vectors.append(vectors)

    def search(self, queries: np.ndarray, scores: np.ndarray, found: np.ndarray, held: list[np.ndarray]) -> np.ndarray:
        """Better ``scores`` and ``found`` (both changed); returns which queries are still open after this block."""
        if not self.ready:
            self.ids, self.vectors = np.concatenate(self.ids), np.concatenate(self.vectors)
            self.lengths = np.append(np.sqrt((self.vectors**2).sum(axis=1)), self.next_length) * (1 + SLACK)
            self.ready = True
        own = np.sqrt((queries**2).sum(axis=1))
        rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
        places = np.concatenate(held) - self.first_place if len(rows) else np.zeros(0, np.int64)
        by_place = np.argsort(places, kind="stable")
        rows, places = rows[by_place], places[by_place]
        going = np.arange(len(queries))
        for at in range(0, len(self.ids), STEP_ITEMS):
            # Equal products are told apart by id, so a bound that only meets the last one does not end the search.
            going = going[own[going] * self.lengths[at] >= scores[going, -1]]
            if not len(going):
                break
            stop = min(at + STEP_ITEMS, len(self.ids))
            products = queries[going] @ self.vectors[at:stop].T
            low, high = np.searchsorted(places, [at, stop])
            if high > low:
                line = np.full(len(queries), -1)
                line[going] = np.arange(len(going))
                asked = line[rows[low:high]] >= 0
                products[line[rows[low:high][asked]], places[low:high][asked] - at] = -np.inf
            # Only rows with a product that reaches their last one have anything to merge.
            better = np.flatnonzero((products >= scores[going, -1:]).any(axis=1))
            mine = going[better]
            all_scores = np.hstack([scores[mine], products[better]])
            all_found = np.hstack([found[mine], np.broadcast_to(self.ids[at:stop], (len(mine), stop - at))])
            best = np.lexsort((all_found, -all_scores), axis=1)[:, : self.k]
            scores[mine] = np.take_along_axis(all_scores, best, axis=1)
            found[mine] = np.take_along_axis(all_found, best, axis=1)
        return own * self.lengths[len(self.ids)] >= scores[:, -1]


def _searched(rows: DataFrame, k: int, width: int, next_length: float) -> DataFrame:
    """One round over rows sorted by slice, with the items first and held places before their query."""

    def run(batches):
        slice_, block, owner, held = None, None, None, []
        waiting: list[tuple] = []

        def flush():
            ids, vectors, scores, found, skipped = zip(*waiting)
            waiting.clear()
            scores, found = np.vstack(scores), np.vstack(found)
            is_open = block.search(np.vstack(vectors), scores, found, list(skipped)) if block else np.zeros(len(ids), bool)
            kept = np.isfinite(scores)
            return {
                "query": list(ids), "features": list(vectors), "is_open": is_open,
                "scores": [s[m] for s, m in zip(scores, kept)], "found": [f[m] for f, m in zip(found, kept)],
            }

        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            slices, names = batch.column("slice").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            places = batch.column("place").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(kinds) != 0) | (np.diff(slices) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(kinds)]):
                if slices[a] != slice_:
                    if waiting:
                        yield flush()
                    slice_, block, owner, held = slices[a], None, None, []
                part = batch.slice(a, b - a)
                if kinds[a] == _ITEM:
                    block = block or _Block(k, next_length)
                    block.add(places[a:b].astype(np.int64), part.column("found").flatten().to_numpy(),
                              matrix_of(part.column("features"), width))
                elif kinds[a] == _HELD:
                    for name, place in zip(names[a:b].tolist(), places[a:b].tolist()):
                        if name != owner:
                            owner, held = name, []
                        held.append(int(place))
                else:
                    vectors = matrix_of(part.column("features"), width)
                    old = zip(part.column("scores").to_pylist(), part.column("found").to_pylist())
                    for i, (name, (s, f)) in enumerate(zip(names[a:b].tolist(), old)):
                        scores, found = np.full(k, -np.inf), np.full(k, np.iinfo(np.int32).max, np.int64)
                        scores[: len(s)], found[: len(f)] = s, f
                        skipped = np.array(held if name == owner else [], np.int64)
                        waiting.append((int(name), vectors[i], scores, found, skipped))
                        if len(waiting) >= BATCH_QUERIES:
                            yield flush()
        if waiting:
            yield flush()

    schema = "query int, features array<float>, is_open boolean, scores array<double>, found array<int>"
    return map_columns(rows, run, schema)


def top_inner_products(
    queries: DataFrame, items: DataFrame, k: int, held: DataFrame | None = None, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """The ``k`` items of largest product with each query, as (query, scores, found), best first, then by id.

    ``queries`` and ``items`` have int ``id`` and ``features`` of one length, an id once; ``held`` (query, item) names
    pairs to leave out. A query with fewer than ``k`` items left gets those; without items it gets empty lists.
    Runs a few jobs and one for each block that some query still needs.
    """
    spark = queries.sparkSession
    places = written(ordered_items(items), "items")
    blocks = F.floor(F.col("place") / block_items).cast("int")
    lengths = places.groupBy(blocks.alias("block")).agg(F.max("length").alias("length"), F.max("place").alias("place"))
    tops = {r["block"]: (r["length"], r["place"]) for r in lengths.collect()}  # one row per block
    waiting = written(
        queries.select(
            F.col("id").alias("query"), "features", F.lit(True).alias("is_open"),
            F.array().cast("array<double>").alias("scores"), F.array().cast("array<int>").alias("found"),
        ),
        "queries",
    )
    if held is not None:
        keyed = held.join(places.select(F.col("id").alias("item"), "place"), "item")
        path = scratch_path(spark, "held")
        keyed.select("query", "place", blocks.alias("block")).write.partitionBy("block").parquet(path)
        held = spark.read.schema("query int, place long, block int").parquet(path)
    done = [waiting.where("not is_open")]
    for block in sorted(tops):
        stats = waiting.agg(F.count("*").alias("n"), F.max(F.size("features")).alias("width")).first()
        if not stats["n"]:
            break
        inside = min(block_items, tops[block][1] - block * block_items + 1)
        products = stats["n"] * inside
        slices = max(-(-products // SLICE_PRODUCTS), min(LEAST_SLICES, -(-products // LEAST_PRODUCTS)))
        own_slice = F.pmod(F.hash("query"), F.lit(slices)).alias("slice")
        empty = F.array().cast("array<double>").alias("scores")
        rows = (
            places.where(blocks == block)
            .select(
                F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(_ITEM).alias("kind"),
                F.lit(None).cast("int").alias("query"), "place", "features", empty, F.array("id").alias("found"),
            )
            .unionByName(
                waiting.select(
                    own_slice, F.lit(_QUERY).alias("kind"), "query", F.lit(None).cast("long").alias("place"),
                    "features", "scores", "found",
                )
            )
        )
        if held is not None:
            rows = rows.unionByName(
                held.where(F.col("block") == block).select(
                    own_slice, F.lit(_HELD).alias("kind"), "query", "place",
                    F.lit(None).cast("array<float>").alias("features"), empty, F.array().cast("array<int>").alias("found"),
                )
            )
        in_order = rows.repartition(slices, "slice").sortWithinPartitions(
            "slice", F.col("kind") != _ITEM, "query", "kind", "place"
        )
        next_length = tops.get(block + 1, (-1.0,))[0]
        searched = written(_searched(in_order, k, stats["width"], next_length), "searched")
        last = block + 1 not in tops
        done.append(searched if last else searched.where("not is_open"))
        waiting = searched.where("is_open")
    else:
        if not tops:
            done.append(waiting)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select("query", "scores", "found")
