"""Dense ids and the sparse wallet x asset matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletlens.functions.columns import filled, sparsity_pct
from walletlens.functions.distinct import distinct_counts
from walletlens.functions.ordering import number_rows
from walletlens.functions.shared_storage import written

# Fixed values.
TOKEN_ADDRESS_PATTERN = r"^0x[0-9a-f]{40}$"
USER_THRESHOLDS = (10, 20, 50)
TOKEN_THRESHOLDS = (10, 20, 50)
MIN_TX = 10
MIN_HOLDERS = 50


def dense_ids(df: DataFrame, key: str, out: str) -> DataFrame:
    """Ids from 1 by ascending distinct key, without a single-partition sort. Runs a job."""
    return number_rows(df.select(key).distinct(), [key], out)


def wallet_universe(transfers: DataFrame) -> DataFrame:
    """Every wallet that sent or received, from a single scan."""
    ends = F.explode(F.array(F.lower("from_address"), F.lower("to_address")))
    return transfers.select(ends.alias("user_address")).filter(filled(F.col("user_address"))).distinct()


def valid_token_addresses(tokens: DataFrame) -> DataFrame:
    """Distinct well-formed asset addresses."""
    return (
        tokens.select(F.lower(F.trim("address")).alias("token_address"))
        .filter(F.col("token_address").rlike(TOKEN_ADDRESS_PATTERN))
        .distinct()
    )


def index_pairs_left(held: DataFrame, user_map: DataFrame, token_map: DataFrame) -> DataFrame:
    """Portfolio rows by id; rows without an id stay with NULL."""
    return (
        held.join(user_map, "user_address", "left")
        .join(token_map, "token_address", "left")
        .select("user_id", "token_id", "balance", "tx_count")
    )


def index_pairs(
    pairs: DataFrame, user_map: DataFrame, token_map: DataFrame, ordered: bool = False
) -> DataFrame:
    """Pairs by id with every other column carried over; unmapped pairs are dropped."""
    keys = ("user_address", "token_address")
    rest = [c for c in pairs.columns if c not in keys]
    normal = pairs.select(*[F.lower(key).alias(key) for key in keys], *rest).filter(
        filled(F.col(keys[0])) & filled(F.col(keys[1]))
    )
    indexed = (
        normal.join(user_map, keys[0], "inner")
        .join(token_map, keys[1], "inner")
        .select("user_id", "token_id", *rest)
    )
    return indexed.orderBy("user_id", "token_id") if ordered else indexed


def index_ends(transfers: DataFrame, user_map: DataFrame) -> DataFrame:
    """Replace both addresses by ids, keeping every other column; unmapped ends become NULL.

    Pass a stored map: plain exchanges on both sides let hub wallets be split at run time.
    """
    senders = user_map.select(
        F.lower("user_address").alias("from_address"), F.col("user_id").alias("from_user_id")
    )
    receivers = user_map.select(
        F.lower("user_address").alias("to_address"), F.col("user_id").alias("to_user_id")
    )
    rest = [c for c in transfers.columns if c not in ("from_address", "to_address")]
    return (
        transfers.select(
            F.lower("from_address").alias("from_address"),
            F.lower("to_address").alias("to_address"),
            *rest,
        )
        .join(senders, "from_address", "left")
        .join(receivers, "to_address", "left")
        .select("from_user_id", "to_user_id", *rest)
    )


def index_transfers(transfers: DataFrame, user_map: DataFrame, token_map: DataFrame) -> DataFrame:
    """Transfers by id; an end or an asset without an id becomes NULL."""
    assets = token_map.select(F.lower("token_address").alias("token_address"), "token_id")
    return (
        index_ends(transfers, user_map)
        .withColumn("token_address", F.lower("token_address"))
        .join(assets, "token_address", "left")
        .select("from_user_id", "to_user_id", "token_id", "adjusted_value")
    )


def unmapped_count(indexed: DataFrame) -> DataFrame:
    """One row: all rows, and rows with any missing id."""
    missing = (
        F.col("from_user_id").isNull() | F.col("to_user_id").isNull() | F.col("token_id").isNull()
    )
    return indexed.agg(
        F.count(F.lit(1)).alias("transfers"), F.count_if(missing).alias("unmapped")
    )


def sparsity(df: DataFrame, user: str, item: str, approximate: bool = False) -> DataFrame:
    """One row: entries, users, tokens and the empty share of the matrix in percent.

    Exact counts come from bitmaps where both columns are ids; see ``distinct_counts``.
    """
    if approximate:
        counts = df.agg(
            F.count(F.lit(1)).alias("entries"),
            F.approx_count_distinct(user).alias("users"),
            F.approx_count_distinct(item).alias("tokens"),
        )
    else:
        counts = distinct_counts(df, {"users": F.col(user), "tokens": F.col(item)}).withColumnRenamed("_rows", "entries")
    return counts.withColumn("sparsity_pct", sparsity_pct("entries", "users", "tokens"))


def user_totals(held: DataFrame) -> DataFrame:
    """Transactions by wallet."""
    return held.groupBy("user_address").agg(F.sum("tx_count").alias("total_tx"))


def token_holders(held: DataFrame) -> DataFrame:
    """Distinct holders by asset."""
    return held.groupBy("token_address").agg(F.count_distinct("user_address").alias("num_holders"))


def score_pairs(held: DataFrame, pair_counts: bool = False) -> DataFrame:
    """Pairs with their wallet's transactions and their asset's holders. Runs two jobs.

    Windows over a wallet or an asset would put a hot one into a single task. The two
    totals combine before their shuffle and are stored, so the joins broadcast them when
    their measured size allows and are otherwise split on hot keys at run time.
    ``pair_counts`` carries the pair's own ``tx_count`` along, for a confidence by pair.
    """
    totals = written(user_totals(held), "user-totals")
    holders = written(token_holders(held), "token-holders")
    own = ["tx_count"] if pair_counts else []
    return (
        held.select("user_address", "token_address", *own)
        .join(totals, "user_address", "left")
        .join(holders, "token_address", "left")
        .select("user_address", "token_address", *own, "total_tx", "num_holders")
    )


def threshold_grid(
    scored: DataFrame,
    min_txs: Sequence[int] = USER_THRESHOLDS,
    min_holders: Sequence[int] = TOKEN_THRESHOLDS,
) -> DataFrame:
    """Size and sparsity of the matrix for every pair of thresholds, empty ones included.

    Each row carries one bit for every cell it is in. Bits of a wallet, or of an asset, are
    joined by or, rows are counted by their bits, and the counts go to the cells at the end:
    no row is copied per combination, nothing is counted distinct, and the totals may differ
    from pair to pair of a wallet or an asset. A grid has at most 63 cells.
    """
    cells = [(t, h) for t in sorted(set(min_txs)) for h in sorted(set(min_holders))]
    if len(cells) > 63:
        raise ValueError("a grid has at most 63 cells")
    inside = [
        F.when((F.col("total_tx") >= t) & (F.col("num_holders") >= h), F.lit(1 << i)).otherwise(0)
        for i, (t, h) in enumerate(cells)
    ]
    masked = scored.select(
        "user_address", "token_address", sum(inside, F.lit(0).cast("long")).alias("mask")
    ).filter(F.col("mask") > 0)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("mask").agg(F.count(F.lit(1)).alias(name))

    def of(key: str) -> DataFrame:
        return masked.groupBy(key).agg(F.bit_or("mask").alias("mask"))

    counts = (
        counted(masked, "entries")
        .unionByName(counted(of("user_address"), "users"), allowMissingColumns=True)
        .unionByName(counted(of("token_address"), "tokens"), allowMissingColumns=True)
    )
    # A row of zeros in every cell keeps the empty ones.
    every_cell = scored.sparkSession.range(1).select(
        F.lit((1 << len(cells)) - 1).cast("long").alias("mask"),
        *[F.lit(0).cast("long").alias(name) for name in ("entries", "users", "tokens")],
    )
    limits = F.array(
        *[
            F.struct(
                F.lit(1 << i).cast("long").alias("bit"),
                F.lit(t).alias("min_tx"),
                F.lit(h).alias("min_holders"),
            )
            for i, (t, h) in enumerate(cells)
        ]
    )
    return (
        counts.unionByName(every_cell)
        .withColumn("cell", F.explode(limits))
        .filter(F.col("mask").bitwiseAND(F.col("cell.bit")) != 0)
        .groupBy("cell.min_tx", "cell.min_holders")
        .agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("entries", "users", "tokens")])
        .withColumn("sparsity_pct", F.round(sparsity_pct("entries", "users", "tokens"), 4))
        .orderBy("sparsity_pct", "min_tx", "min_holders")
    )


def filter_pairs(
    scored: DataFrame, min_tx: int = MIN_TX, min_holders: int = MIN_HOLDERS
) -> DataFrame:
    """Pairs at or over both limits, in a single pass (see ``sparsity`` for the metrics)."""
    return scored.filter((F.col("total_tx") >= min_tx) & (F.col("num_holders") >= min_holders))
