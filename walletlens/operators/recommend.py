"""Implicit-feedback recommendations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.functions.shared_storage import shared_root, written
from walletlens.operators.certificate import optimality
from walletlens.operators.evaluate import CUTOFFS, ndcg_at_k, ranking_metrics
from walletlens.operators.inner_product import top_inner_products
from walletlens.operators.route import SAFE_MODE, TOP_N, known_wallets, route_recommendations

# Fixed values.
USER_COL = "user_id_int"
ITEM_COL = "token_id_int"
RATING_COL = "ultimate_confidence"
MAX_ITER = 20
SEED = 42
SELECTION_K = 10

# Ids that make up a block, and the fewest blocks of a side that has as many ids. Factors start
# by block, so blocks follow from the data alone: another cluster gives the same model.
USERS_PER_BLOCK = 20_000
ITEMS_PER_BLOCK = 20_000
LEAST_USER_BLOCKS = 8
LEAST_ITEM_BLOCKS = 2


@dataclass(frozen=True)
class AlsSetting:
    """One point of the model grid."""

    rank: int
    reg: float
    alpha: float

    @property
    def label(self) -> str:
        return f"rank={self.rank} reg={self.reg:.2f} alpha={self.alpha:.0f}"


# The settings to choose from.
MODEL_GRID = (
    AlsSetting(rank=30, reg=0.1, alpha=15.0),
    AlsSetting(rank=50, reg=0.1, alpha=15.0),
    AlsSetting(rank=50, reg=0.05, alpha=20.0),
    AlsSetting(rank=50, reg=0.01, alpha=25.0),
)


def block_counts(interactions: DataFrame) -> tuple[int, int]:
    """User and item blocks from the number of ids; few item blocks keep top-k tasks few. Runs a job."""
    counted = [
        interactions.select(column).distinct().agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(column))
        for column in (USER_COL, ITEM_COL)
    ]
    n = {row["side"]: row["n"] for row in counted[0].unionByName(counted[1]).collect()}

    def blocks(ids: int, per_block: int, least: int) -> int:
        return max(1, min(least, ids), -(-ids // per_block))

    return (
        blocks(n[USER_COL], USERS_PER_BLOCK, LEAST_USER_BLOCKS),
        blocks(n[ITEM_COL], ITEMS_PER_BLOCK, LEAST_ITEM_BLOCKS),
    )


def train_als(
    interactions: DataFrame,
    rank: int,
    reg: float,
    alpha: float,
    max_iter: int = MAX_ITER,
    seed: int = SEED,
    user_blocks: int | None = None,
    item_blocks: int | None = None,
) -> ALSModel:
    """Fit non-negative implicit ALS on ``(user_id_int, token_id_int, ultimate_confidence)``.

    Users and items are split into blocks by their number of ids (see ``block_counts``). Rows
    are dealt by a hash of their ids first, as the library adds up in the order it meets them.
    """
    # ALS cuts its own lineage every few rounds once a checkpoint folder is known.
    shared_root(interactions.sparkSession)
    if user_blocks is None or item_blocks is None:
        counted = block_counts(interactions)
        user_blocks, item_blocks = user_blocks or counted[0], item_blocks or counted[1]
    rows = interactions.select(USER_COL, ITEM_COL, RATING_COL)
    ordered = rows.repartition(user_blocks, USER_COL).sortWithinPartitions(USER_COL, ITEM_COL)
    return ALS(
        numUserBlocks=user_blocks,
        numItemBlocks=item_blocks,
        rank=rank,
        regParam=reg,
        alpha=alpha,
        maxIter=max_iter,
        seed=seed,
        implicitPrefs=True,
        nonnegative=True,
        coldStartStrategy="drop",
        userCol=USER_COL,
        itemCol=ITEM_COL,
        ratingCol=RATING_COL,
    ).fit(ordered)


def recommend_top_n(
    model: ALSModel, users: DataFrame, k: int, exclude_seen: DataFrame | None = None
) -> DataFrame:
    """The ``k`` best items of each user as ``(user_id_int, rank, token_id_int, score)``.

    Users the model never saw have no rows. Items a user already holds stay in, unless ``exclude_seen`` names them as
    ``(user_id_int, token_id_int)``; they are passed over during the search, so a user with many costs nothing to others.
    The search is exact (see ``inner_product``); equal scores are in order of items. Runs jobs.
    """
    wanted = users.select(F.col(USER_COL).alias("id")).distinct()
    held = None
    if exclude_seen is not None:
        held = exclude_seen.select(F.col(USER_COL).alias("query"), F.col(ITEM_COL).alias("item"))
    found = top_inner_products(model.userFactors.join(wanted, "id", "left_semi"), model.itemFactors, k, held)
    entries = F.arrays_zip(F.col("found").alias(ITEM_COL), F.col("scores").alias("score"))
    return found.select(F.col("query").alias(USER_COL), F.posexplode(entries).alias("position", "entry")).select(
        USER_COL, (F.col("position") + 1).alias("rank"), f"entry.{ITEM_COL}", "entry.score"
    )


def certify_model(model: ALSModel, train: DataFrame, reg: float, alpha: float) -> DataFrame:
    """Per trained user, whether its factors are the best for the items' factors (see ``certificate.optimality``).

    A round of the fit solves items first and users last, so users are what can be held to it. ``train``, ``reg``
    and ``alpha`` are those of the fit; ratings count as single floats, as they do there.
    """
    rating = F.col(RATING_COL).cast("float").cast("double").alias("rating")
    ratings = train.select(F.col(USER_COL).alias("id"), F.col(ITEM_COL).alias("other"), rating)
    return optimality(model.userFactors, model.itemFactors, ratings, reg, alpha)


def evaluate_model(model: ALSModel, test: DataFrame, ks: Sequence[int] = CUTOFFS) -> DataFrame:
    """Ranking metrics of a model on held-out rows; one list per user serves every cutoff."""
    return ranking_metrics(recommend_top_n(model, test, max(ks)), test, ks)


def recommend_for_user(
    user_id: str | int,
    model: ALSModel,
    history: DataFrame,
    safe: DataFrame,
    trending: DataFrame,
    top_n: int = TOP_N,
    risk_mode: str | None = SAFE_MODE,
) -> DataFrame:
    """The router for a single wallet; use ``route_recommendations`` for more than a few."""
    spark = history.sparkSession
    request = spark.createDataFrame(
        [(str(user_id), risk_mode)], "user_id string, risk_mode string"
    )
    user = known_wallets(request, history).select(USER_COL)
    recs = recommend_top_n(model, user, top_n)
    return route_recommendations(request, history, recs, safe, trending, top_n)


def select_model(
    train: DataFrame,
    test: DataFrame,
    grid: Sequence[AlsSetting] = MODEL_GRID,
    k: int = SELECTION_K,
    max_iter: int = MAX_ITER,
    min_interactions: int = 0,
) -> tuple[ALSModel, DataFrame]:
    """Fit every setting and keep the best NDCG@k; the first wins a tie.

    Returns the model and a table ``(label, ndcg, users, best)``, best first. Only one number
    per setting reaches the driver, and a losing model's factors leave the executors at once. ``min_interactions`` can drop users with fewer rows.
    """
    if min_interactions > 0:
        busy = train.groupBy(USER_COL).count().filter(F.col("count") >= min_interactions)
        train = train.join(busy.select(USER_COL), USER_COL, "left_semi")
    train, test = written(train, "train"), written(test, "test")
    best, rows = None, []
    for setting in grid:
        before = _persisted(train.sparkSession)
        model = train_als(train, setting.rank, setting.reg, setting.alpha, max_iter)
        kept = {key: rdd for key, rdd in _persisted(train.sparkSession).items() if key not in before}
        result = ndcg_at_k(recommend_top_n(model, test, k), test, k).first()
        rows.append((setting.label, result["ndcg"], result["users"]))
        loser = kept
        if best is None or result["ndcg"] > best[0]:  # the first of equal ones stays
            loser = best[2] if best else {}
            best = (result["ndcg"], model, kept, setting.label)
        for rdd in loser.values():
            rdd.unpersist()
    table = (
        train.sparkSession.createDataFrame(rows, "label string, ndcg double, users bigint")
        .withColumn("best", F.col("label") == best[3])
        .orderBy(F.desc("ndcg"), F.desc("best"))
    )
    return best[1], table


def _persisted(spark: SparkSession) -> dict:
    """What the context keeps in executors' storage, by number; a fit leaves its factors there."""
    return dict(spark.sparkContext._jsc.getPersistentRDDs())


def save_model(model: ALSModel, path: str) -> None:
    """Store a model, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """Read a stored model."""
    return ALSModel.load(path)
