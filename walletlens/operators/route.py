"""Cold-start catalogs and the batch router."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
SAFE_MIN_HOLDERS = 1000
TRENDING_LOW = 10
TRENDING_HIGH = 5000
TOP_N = 10
SAFE_MODE = "safe"


def _by_token(rows: DataFrame, score: Column, name: str, ordered: bool) -> DataFrame:
    catalog = (
        rows.groupBy("token_id_int", "token_id")
        .agg(
            F.max("num_holders").alias("num_holders"),
            F.sum("total_tx").alias("total_volume"),
        )
        .withColumn(name, score)
    )
    return catalog.orderBy(F.desc(name), "token_id_int") if ordered else catalog


def safe_catalog(
    interactions: DataFrame, min_holders: int = SAFE_MIN_HOLDERS, ordered: bool = False
) -> DataFrame:
    """Widely held assets by ``safety_score``."""
    score = F.log1p("num_holders") * F.log1p("total_volume")
    rows = interactions.filter(F.col("num_holders") > min_holders)
    return _by_token(rows, score, "safety_score", ordered)


def trending_catalog(
    interactions: DataFrame,
    low: int = TRENDING_LOW,
    high: int = TRENDING_HIGH,
    ordered: bool = False,
) -> DataFrame:
    """Assets on the rise by ``momentum_score``, transactions per holder."""
    score = F.col("total_volume") / F.col("num_holders")
    rows = interactions.filter((F.col("num_holders") >= low) & (F.col("num_holders") < high))
    return _by_token(rows, score, "momentum_score", ordered)


def _best(catalog: DataFrame, score: str, source: str, top_n: int) -> DataFrame:
    # One row per catalog: its top_n entries, best first.
    top = catalog.select(F.col(score).alias("score"), "token_id_int").orderBy(
        F.desc("score"), "token_id_int"
    ).limit(top_n)
    entry = F.struct((-F.col("score")).alias("_order"), "token_id_int", "score")
    return top.agg(F.sort_array(F.collect_list(entry)).alias("entries")).withColumn(
        "source", F.lit(source)
    )


def known_wallets(requests: DataFrame, history: DataFrame) -> DataFrame:
    """(user_id as text, user_id_int) of the requested wallets that have history.

    ``history`` may be any table that holds both ids, such as the id map. Requested ids take the
    type of its own, so the filter reaches the scan and only matching rows are made distinct.
    """
    kind = history.schema["user_id"].dataType.simpleString()
    asked = requests.select(F.col("user_id").cast("string").alias("_asked")).distinct()
    asked = asked.select("_asked", F.expr(f"try_cast(_asked as {kind})").alias("user_id"))
    found = history.select("user_id", "user_id_int").join(asked, "user_id")
    same = F.col("user_id").cast("string") == F.col("_asked")  # "007" is not 7
    return found.filter(same).select(F.col("_asked").alias("user_id"), "user_id_int").distinct()


def resolve_requests(requests: DataFrame, user_map: DataFrame) -> DataFrame:
    """``requests`` (wallet, risk_mode) with ``user_id`` as text: a wallet is an address or already an id.

    Addresses count without regard to case and to white space around them. What is no known address stays as it is, and
    so finds no history unless it is an id. Pass a map that is published in buckets by ``user_address``
    (``sources.versions``): then only the requests are exchanged.
    """
    known = user_map.select(F.col("user_address").alias("_address"), F.col("user_id").cast("string").alias("_id"))
    asked = requests.select("wallet", "risk_mode").distinct()
    return asked.join(known, F.lower(F.trim("wallet")) == F.col("_address"), "left").select(
        "wallet", "risk_mode", F.coalesce("_id", F.trim("wallet")).alias("user_id")
    )


def route_wallets(
    requests: DataFrame,
    user_map: DataFrame,
    history: DataFrame,
    recs: DataFrame,
    safe: DataFrame,
    trending: DataFrame,
    top_n: int = TOP_N,
) -> DataFrame:
    """``route_recommendations`` for wallets named by address or id: ``(wallet, risk_mode, rank, token_id_int, score, source)``.

    Several names of one wallet each get its answer, from one list.
    """
    resolved = resolve_requests(requests, user_map)
    answers = route_recommendations(resolved.select("user_id", "risk_mode"), history, recs, safe, trending, top_n)
    own = answers.withColumnRenamed("risk_mode", "_mode").withColumnRenamed("user_id", "_user")
    same = F.col("user_id").eqNullSafe(F.col("_user")) & F.col("risk_mode").eqNullSafe(F.col("_mode"))
    return resolved.join(own, same).select("wallet", "risk_mode", "rank", "token_id_int", "score", "source")


def route_recommendations(
    requests: DataFrame,
    history: DataFrame,
    recs: DataFrame,
    safe: DataFrame,
    trending: DataFrame,
    top_n: int = TOP_N,
    strict: bool = False,
) -> DataFrame:
    """Answer the distinct ``requests (user_id, risk_mode)`` in one batch.

    A wallet with history gets its rows of ``recs`` (see ``recommend_top_n``), any other the
    top of the safe catalog when it asks for "safe" and of the trending one otherwise.
    Known wallets without recommendations fall back too, unless ``strict``. Returns
    ``(user_id, risk_mode, rank, token_id_int, score, source)``.
    """
    known = known_wallets(requests, history)
    lists = (
        recs.filter(F.col("rank") <= top_n)
        .groupBy("user_id_int")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("rank", "token_id_int", "score"))
            ).alias("own")
        )
    )
    routed = (
        requests.select(F.col("user_id").cast("string").alias("user_id"), "risk_mode")
        .distinct()
        .join(known, "user_id", "left")
        .join(lists, "user_id_int", "left")
    )
    wants_safe = F.coalesce(F.col("risk_mode") == SAFE_MODE, F.lit(False))
    fallback = F.when(wants_safe, F.lit(SAFE_MODE)).otherwise(F.lit("trending"))
    served = F.col("user_id_int").isNotNull() if strict else F.col("own").isNotNull()
    routed = routed.withColumn("source", F.when(served, F.lit("als")).otherwise(fallback))
    # Two rows, one per catalog, of top_n entries each.
    catalogs = _best(safe, "safety_score", SAFE_MODE, top_n).unionByName(
        _best(trending, "momentum_score", "trending", top_n)
    )
    answers = routed.join(F.broadcast(catalogs), "source", "left")

    def plain(entries: str) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct(
                e["token_id_int"].alias("token_id_int"), e["score"].alias("score")
            ),
        )

    chosen = F.when(F.col("source") == "als", plain("own")).otherwise(plain("entries"))
    return answers.select(
        "user_id", "risk_mode", "source", F.posexplode(chosen).alias("position", "entry")
    ).select(
        "user_id",
        "risk_mode",
        (F.col("position") + 1).alias("rank"),
        "entry.token_id_int",
        "entry.score",
        "source",
    )
