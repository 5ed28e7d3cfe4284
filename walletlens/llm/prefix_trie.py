"""Prefix trie of conversations from sorted, padded matrices of turn ids.

A conversation is a path of turns, and a trie node is a distinct beginning of paths.  Paths are dealt to shards by
range, so each node is a run of neighbours.  A shard numbers its turns, pads its paths to a matrix of those ids
and sorts the rows by ``numpy.lexsort``.  Columns that differ from the row above, OR-accumulated from the left, show
where a node of each depth starts; ``reduceat`` over those starts then gives the figures of all nodes of a depth.

Each figure is a sum over the rows of a node, given how many turns a row shares with the row above and the
row below.  A node on the border of a shard is therefore put together by sums over shards, with a
correction for each pair of neighbouring rows that two shards see.  A path that a third of all conversations take
is dealt to as many shards as it needs, since ranges are cut by path and conversation id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import written
from walletlens.llm.common import map_batches
from walletlens.llm.mixing import words

FAMILY = 20
MOST_SHARED = 4
SHARD_TURNS = 200_000
COLUMNS_AT_ONCE = 16
ID_BYTES = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of turn, id, n_words) in order of turn; the texts are left behind.

    Null turns come first, null roles and texts are empty, and rows of one turn follow each other by the hash of role and
    text. A turn's id is half a SHA-256, in hex. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    # The length of the role keeps apart what joins to the same text.
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        "turn",
        F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * ID_BYTES).alias("id"),
        words(F.col("text")).cast("int").alias("n_words"),
    )
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    )


def rebuilt_paths(paths: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> DataFrame:
    """conv_id, path (ids of all turns as bytes), n_words (by turn): each conversation with its family's beginning.

    The first h turns of conversation c come from conversation c - c % ``family`` (all it has if fewer, none if it is
    absent) and the others are its own from turn h on; h is the crc32 of c in decimal modulo ``most_shared``.
    """
    first = F.expr(f"slice(turns, 1, {most_shared})")
    givers = paths.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("giver"), first.alias("given"))
    giver = F.col("conv_id") - F.col("conv_id") % family
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_shared).cast("int")
    joined = paths.withColumn("giver", giver).withColumn("h", h).join(givers, "giver", "left")
    turns = F.expr(
        "concat(coalesce(slice(given, 1, h), slice(turns, 1, 0)), slice(turns, h + 1, size(turns)))"
    )
    return joined.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.unhex(F.array_join("turns.id", "")).alias("path"), F.col("turns.n_words").alias("n_words")
    )


def turn_numbers(turns: np.ndarray) -> np.ndarray:
    """Dense numbers from 1 on of turn ids (two unsigned words each), in the order of the ids."""
    order = np.lexsort((turns[:, 1], turns[:, 0]))
    ordered = turns[order]
    numbers = np.empty(len(turns), np.int64)
    numbers[order] = np.cumsum(np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))[: len(turns)])
    return numbers


def ordered_paths(numbers, starts, lengths, names, width: int = COLUMNS_AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """(order of rows by path and then name, turns that each row in order shares with the one before; -1 for the first).

    The padded matrix is made ``width`` columns at a time, and later columns only of rows that agree up to
    there, if one of them goes on, so cells are bounded by turns however long a single path is.
    """
    order = np.argsort(names, kind="stable")
    shared = np.full(len(order), -1, np.int64)
    tied, label, at = np.arange(len(order)), np.zeros(len(order), np.int64), 0
    while len(tied):
        rows = order[tied]
        columns = at + np.arange(min(width, max(1, int(lengths[rows].max()) - at)))
        alive = columns < lengths[rows][:, None]
        padded = np.zeros(alive.shape, np.int64)
        padded[alive] = numbers[(starts[rows][:, None] + columns)[alive]]
        by_path = np.lexsort((*padded.T[::-1], label))  # stable, so names stay in order
        order[tied] = rows = rows[by_path]
        padded = padded[by_path]
        changed = np.ones(padded.shape, bool)
        changed[1:] = padded[1:] != padded[:-1]
        changed[np.diff(label, prepend=-1) != 0] = True
        changed = np.logical_or.accumulate(changed, axis=1)
        agreed = (~changed).sum(axis=1)
        inside = np.diff(label, prepend=-1) == 0
        shared[tied[inside]] = np.minimum(at + agreed, lengths[rows])[inside]
        at += len(columns)
        label = np.cumsum(~(inside & (agreed == len(columns))))
        # Rows that end here stay next to a tied one that goes on; its next column parts them.
        goes_on = np.bincount(label, weights=lengths[rows] > at) > 0
        several = np.bincount(label) > 1
        kept = (goes_on & several)[label]
        tied, label = tied[kept], label[kept]
    if len(shared):
        shared[0] = -1
    return order, shared


def prefix_keys(path: bytes) -> list[bytes]:
    """A key for each beginning of a path, the empty one first."""
    digest, out = hashlib.sha256(), []
    for at in range(0, len(path) + 1, ID_BYTES):
        out.append(digest.digest()[:ID_BYTES])
        digest.update(path[at : at + ID_BYTES])
    return out


def shard_nodes(names: np.ndarray, path: np.ndarray, n_words: np.ndarray, lengths: np.ndarray):
    """Columns of nodes, one depth after the other, for paths whose turns lie one after the other in ``path``.

    The two paths at the shard's borders may go on in its neighbours: their nodes carry ``key``, ``parent_key`` and
    the ids of conversations that end there (``ends``) in place of a digest. A node with such a parent
    has its ``parent_slot`` in place of its conversation. Each border counts as a change of path, here.
    """
    starts = np.cumsum(lengths) - lengths
    numbers = turn_numbers(path.view(">u8").astype(np.uint64).reshape(-1, 2))
    order, shared = ordered_paths(numbers, starts, lengths, names)
    names, starts, lengths = names[order], starts[order], lengths[order]
    below = np.append(shared[1:], -1)
    leaf = below < lengths
    spent = np.concatenate([[0], np.cumsum(n_words)])
    raw = path.tobytes()
    first, last = (raw[ID_BYTES * starts[i] : ID_BYTES * (starts[i] + lengths[i])] for i in (0, -1))
    keys = [prefix_keys(first), prefix_keys(last)]
    alive = np.arange(len(names))
    parents = parent_names = parent_slots = None
    for depth in range(int(lengths.max()) + 1):
        alive = alive[lengths[alive] >= depth]
        above, length, name = shared[alive], lengths[alive], names[alive]
        begin = np.flatnonzero(above < depth)
        total = lambda values: np.add.reduceat(values.astype(np.int64), begin)  # noqa: E731, B023
        until_shared = spent[starts[alive] + np.maximum(above, 0)] - spent[starts[alive] + max(depth - 1, 0)]
        ended = total(length == depth)
        ends = [
            ",".join(map(str, name[b : b + n].tolist())) if n else "" for b, n in zip(begin.tolist(), ended.tolist())
        ]
        node_names = np.minimum.reduceat(name, begin)
        at = alive[begin]
        # Nodes that hold the first or the last row may reach into the shards beside.
        slots = np.full(len(begin), -1)
        if alive[-1] == len(names) - 1:
            slots[-1] = 2 * depth + 1
        if alive[0] == 0:
            slots[0] = 2 * depth
        out = {
            "conv_id": node_names, "depth": np.full(len(begin), depth),
            "n_convs": np.diff(begin, append=len(alive)),
            "n_children": total((above <= depth) & (length > depth)),
            "n_leaves": total(leaf[alive]), "saved_tokens": total(np.where(above >= depth, until_shared, 0)),
            "slot": slots,
            "ends": [e if s >= 0 else hashlib.sha256(e.encode()).hexdigest() if e else NO_ENDS
                     for e, s in zip(ends, slots.tolist())],
            "key": [keys[s % 2][depth] if s >= 0 else None for s in slots.tolist()],
        }
        if depth:
            parent = np.searchsorted(parents, at, side="right") - 1
            open_parent = parent_slots[parent]
            out["parent_slot"] = open_parent
            out["parent_conv_id"] = pa.array(parent_names[parent], mask=open_parent >= 0)
            out["parent_key"] = [keys[s % 2][depth - 1] if s >= 0 else None for s in slots.tolist()]
        else:
            out |= {"parent_slot": np.full(1, -1), "parent_conv_id": [None], "parent_key": [None]}
        yield out
        parents, parent_names, parent_slots = at, node_names, slots
    yield {"first": [first], "last": [last], "first_words": [n_words[starts[0] : starts[0] + lengths[0]].tolist()]}


_NODE = (
    "shard int, slot int, key binary, parent_key binary, parent_slot int, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "first binary, last binary, first_words array<long>"
)


def _shards(paths: DataFrame, shard_turns: int) -> DataFrame:
    """The nodes of all shards, and one row per shard with the paths at its borders (``first`` is not null)."""
    turns = paths.agg(F.sum(F.size("n_words") + 1)).first()[0] or 0
    least = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = paths.repartitionByRange(max(least, -(-turns // shard_turns)), "path", "conv_id")

    def run(batches):
        shard = TaskContext.get().partitionId()
        names, paths_, words_, lengths = [], [], [], []
        for batch in batches:
            path, counts = batch.column("path"), batch.column("n_words")
            names.append(batch.column("conv_id").to_numpy())
            paths_.append(np.frombuffer(b"".join(path.to_pylist()), np.uint8))
            words_.append(counts.flatten().to_numpy().astype(np.int64))
            lengths.append(pa.compute.list_value_length(counts).to_numpy().astype(np.int64))
        if not sum(map(len, names)):
            return
        columns = [part.split()[0] for part in _NODE.split(", ")]
        for out in shard_nodes(*(np.concatenate(x) for x in (names, paths_, words_, lengths))):
            n = len(next(iter(out.values())))
            for at in range(0, n, 10_000):
                rows = len(range(at, min(n, at + 10_000)))
                part = {k: v[at : at + rows] for k, v in out.items()} | {"shard": [shard] * rows}
                yield {c: part.get(c, [None] * rows) for c in columns}

    return map_batches(ranged, run, _NODE)


def _corrections(borders: DataFrame) -> DataFrame:
    """What nodes that two shards share counted too much or too little where the shards meet.

    ``borders`` has one row per shard and meets in one window, no path of another row does.
    """
    before = Window.partitionBy().orderBy("shard")
    pairs = borders.withColumn("above", F.lag("last").over(before)).where("above is not null")

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("key", "n_children", "n_leaves", "saved_tokens")}
            for above, first, spent in zip(*(batch.column(c).to_pylist() for c in ("above", "first", "first_words"))):
                ids = [[p[i : i + ID_BYTES] for i in range(0, len(p), ID_BYTES)] for p in (above, first)]
                shared = next((i for i, (a, b) in enumerate(zip(*ids)) if a != b), min(map(len, ids)))
                keys = prefix_keys(first[: shared * ID_BYTES])
                # The words of the turns from each shared node down to the last shared one.
                rest = np.concatenate([np.cumsum(np.array(spent[:shared], np.int64)[::-1])[::-1], [0]])
                out["key"] += keys
                out["n_children"] += [-1] * shared + [0]
                out["n_leaves"] += [-int(shared == len(ids[0]))] * len(keys)
                out["saved_tokens"] += [int(rest[max(depth - 1, 0)]) for depth in range(len(keys))]
            yield out

    return map_batches(
        pairs.select("above", "first", "first_words"), run,
        "key binary, n_children long, n_leaves long, saved_tokens long",
    )


def _joined_ends(open_nodes: DataFrame) -> DataFrame:
    """key, digest of the ids that end at a node of several shards; shards hold them in ascending order.

    A digest is a fold along one stream, so a node's shards meet in one task, a shard's ids in one row and never all at once.
    """

    def run(batches):
        key = digest = None
        for batch in batches:
            keys, found = [], []
            for name, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if name != key:
                    if key is not None:
                        keys.append(key)
                        found.append(digest.hexdigest())
                    key, digest = name, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            yield {"key": keys, "digest": found}
        if key is not None:
            yield {"key": [key], "digest": [digest.hexdigest()]}

    parts = open_nodes.where("ends <> ''").select("key", "shard", "ends")
    return map_batches(
        parts.repartition("key").sortWithinPartitions("key", "shard"), run, "key binary, digest string"
    )


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every trie node.

    ``paths``: conv_id, path, n_words as of ``rebuilt_paths``, one row per conversation; an empty path ends at the root.
    No paths give no nodes, not even a root. A path is held whole by one task at 20 bytes a turn.
    """
    nodes = written(_shards(written(paths, "paths"), shard_turns), "nodes")
    figures = ("n_children", "n_leaves", "saved_tokens")
    open_nodes = nodes.where("key is not null")
    fixes = _corrections(nodes.where("first is not null").select("shard", "first", "last", "first_words"))
    counted = open_nodes.select("key", "parent_key", "conv_id", "depth", "n_convs", *figures).unionByName(
        fixes, allowMissingColumns=True
    )
    whole = written(
        counted.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.max("parent_key").alias("parent_key"),
            F.max("depth").alias("depth"),
            *(F.sum(c).alias(c) for c in ("n_convs", *figures)),
        ),
        "open-nodes",
    )
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", *figures, "ends_sha256")
    above = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    ended = F.coalesce("digest", F.lit(NO_ENDS)).alias("ends_sha256")
    joined = whole.join(above, "parent_key", "left").join(_joined_ends(open_nodes), "key", "left")
    # A parent on the border is looked up by shard and slot: no key has more rows than a shard.
    slots = open_nodes.join(whole.select("key", F.col("conv_id").alias("found")), "key").select(
        "shard", F.col("slot").alias("parent_slot"), "found"
    )
    closed = nodes.where("key is null and first is null").withColumnRenamed("ends", "ends_sha256")
    looked_up = closed.where("parent_slot >= 0").drop("parent_conv_id").join(slots, ["shard", "parent_slot"])
    return (
        closed.where("parent_slot < 0")
        .select(*columns)
        .union(looked_up.withColumn("parent_conv_id", F.col("found")).select(*columns))
        .union(joined.withColumn("ends_sha256", ended).select(*columns))
    )


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """``trie_nodes`` of all conversations (conv_id integer, turn, role, text; other columns are ignored) after rebuilding."""
    paths = written(turn_paths(conversations), "turns")
    return trie_nodes(rebuilt_paths(paths), shard_turns)
