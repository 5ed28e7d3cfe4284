"""Registered queries: one per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from walletlens.functions.shared_storage import scratch_path
from walletlens.operators import (
    balances,
    clean,
    distribution,
    evaluate,
    features,
    gas,
    graph,
    lasting_ids,
    matrix,
    portfolio,
    rank_update,
    recommend,
    route,
)
from walletlens.plans.pipeline import WalletPipeline
from walletlens.plans.sample_views import SampleViews
from walletlens.session import tune
from walletlens.sources import days, extracts, tables, versions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Ranges of the extracts, and sizes of the samples, for the benchmark tables.
TX_RANGE = ("2024-01-05", "2024-01-20")
TRANSFER_RANGE = ("1996-01-01", "1998-01-01")
CONTRACT_RANGE = ("2023-01-01", "2026-04-01")
# Runs that overlap, and one that is a rerun; the days that are read start and end inside them.
DAY_RUNS = (("1997-01-01", "1997-03-15"), ("1997-03-01", "1997-05-01"), ("1997-02-10", "1997-02-12"))
DAYS_READ = ("1997-01-15", "1997-04-20")
# Cuts that are held against the ranks of all prices.
SKETCH_SHARES = (0.05, 0.5, 0.95)
# Where slices of all transfers begin.
SLICE_DAYS = ("1994-06-01", "1996-06-01")
# How far one more round may move a rank that is kept over slices.
RANK_TOLERANCE = 0.05
POPULAR = 20
TOP_K, MID_K, LOW_K = 100, 150, 250
RANK_DIGITS = 9
# The setting of the queries that fit one model: rank 50, reg 0.1, alpha 15.
DEFAULT_SETTING = recommend.MODEL_GRID[1]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: sums differ in their last bits by row order."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)}
    return df.select(
        *[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


def _on_views(build: Callable[[SampleViews], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(SampleViews(tune(spark), sf_dir)))


def _on_pipeline(build: Callable[[WalletPipeline], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(SampleViews(tune(spark), sf_dir).pipeline()))


def view_query(build: Callable[[SampleViews], DataFrame]):
    """Register a query over the raw sample views."""
    QUERIES[build.__name__] = _on_views(build)
    return build


def stage_query(build: Callable[[WalletPipeline], DataFrame]):
    """Register a query over the pipeline stages."""
    QUERIES[build.__name__] = _on_pipeline(build)
    return build


# Extract, scan, sink ---------------------------------------------------------------------


@view_query
def extract_transactions(views: SampleViews) -> DataFrame:
    return extracts.extract_transactions(views.raw_transactions(), *TX_RANGE)


@view_query
def extract_tokens(views: SampleViews) -> DataFrame:
    return extracts.extract_tokens(views.tokens())


@view_query
def extract_transfers(views: SampleViews) -> DataFrame:
    return extracts.extract_transfers(views.transfers(), *TRANSFER_RANGE)


@view_query
def extract_contracts(views: SampleViews) -> DataFrame:
    return extracts.extract_contracts(views.all_contracts(), *CONTRACT_RANGE)


@view_query
def read_slices(views: SampleViews) -> DataFrame:
    transactions = views.transactions()
    days = F.dayofmonth("block_timestamp")
    slices = [days <= 10, (days > 10) & (days <= 20), days > 20]
    paths = [scratch_path(views.spark, "slice") for _ in slices]
    for path, condition in zip(paths, slices):
        tables.write_table(transactions.filter(condition), path)
    return tables.read_slices(views.spark, paths, transactions.schema)


@view_query
def read_first_available(views: SampleViews) -> DataFrame:
    present = scratch_path(views.spark, "tokens")
    tables.write_table(views.tokens(), present)
    return tables.read_first_available(views.spark, [f"{present}-missing", present])


@view_query
def read_token_csv(views: SampleViews) -> DataFrame:
    path = scratch_path(views.spark, "csv")
    tables.write_table(views.tokens(), path, fmt="csv", n_files=8)
    return tables.read_token_csv(views.spark, path)


@view_query
def write_table(views: SampleViews) -> DataFrame:
    path = scratch_path(views.spark, "export")
    contracts = views.all_contracts()
    tables.write_table(contracts, path, n_files=10, partition_by=["is_erc20"])
    return tables.read_slices(views.spark, [path], contracts.schema)


@view_query
def catalog_table(views: SampleViews) -> DataFrame:
    path = scratch_path(views.spark, "catalog")
    name = f"contracts_{uuid.uuid4().hex}"
    return tables.save_catalog_table(views.all_contracts(), name, path=path)


@view_query
def publish_table(views: SampleViews) -> DataFrame:
    """Two versions of one table; a version is what was published last."""
    root, contracts = scratch_path(views.spark, "published"), views.all_contracts()
    versions.publish(contracts.where("is_erc20"), root)
    versions.publish(contracts, root)
    return versions.read_published(views.spark, root)


@view_query
def slices_by_day(views: SampleViews) -> DataFrame:
    path = scratch_path(views.spark, "days")
    for run in DAY_RUNS:
        days.write_days(extracts.extract_transfers(views.transfers(), *run), path, *run)
    schema = extracts.extract_transfers(views.transfers(), *DAYS_READ).schema
    return days.read_days(views.spark, path, schema, *DAYS_READ)


# Clean and portfolio ---------------------------------------------------------------------


@stage_query
def clean_tokens(stages: WalletPipeline) -> DataFrame:
    return stages.tokens


@stage_query
def normalize_transfers(stages: WalletPipeline) -> DataFrame:
    return stages.normalized


@stage_query
def processed_transfers(stages: WalletPipeline) -> DataFrame:
    return stages.processed


@stage_query
def signed_flows(stages: WalletPipeline) -> DataFrame:
    return stages.flows.drop("amount", "decimals")


@stage_query
def portfolios(stages: WalletPipeline) -> DataFrame:
    return stages.portfolios


@view_query
def contract_addresses(views: SampleViews) -> DataFrame:
    return portfolio.contract_addresses(views.all_contracts())


@view_query
def portfolios_fractional(views: SampleViews) -> DataFrame:
    """Balances over fractions: those that come to nothing must not stay."""
    assets = clean.clean_tokens(views.tokens())
    exact = clean.normalize_transfers(views.fractional_transfers(), assets, keep_amount=True)
    return portfolio.portfolios(portfolio.signed_flows(exact))


@stage_query
def label_contracts(stages: WalletPipeline) -> DataFrame:
    return stages.labelled


@stage_query
def label_counts(stages: WalletPipeline) -> DataFrame:
    return portfolio.label_counts(stages.labelled)


@stage_query
def real_users(stages: WalletPipeline) -> DataFrame:
    return stages.real_users


@stage_query
def real_portfolios(stages: WalletPipeline) -> DataFrame:
    return stages.real_portfolios


@stage_query
def user_activity(stages: WalletPipeline) -> DataFrame:
    return stages.activity


# Gas -------------------------------------------------------------------------------------


@stage_query
def user_gas_hourly(stages: WalletPipeline) -> DataFrame:
    return stages.user_gas_hourly


@stage_query
def gas_cutoff(stages: WalletPipeline) -> DataFrame:
    return gas.gas_cutoff(stages.transactions, rel_err=0)


@stage_query
def gas_cutoff_over_slices(stages: WalletPipeline) -> DataFrame:
    """The cut from daily sketches, and that of the default path, against the ranks of all prices."""
    root = scratch_path(stages.transactions.sparkSession, "sketches")
    sketches = gas.gas_sketches(stages.transactions)
    even = F.dayofmonth("date") % 2 == 0
    versions.publish(sketches.where(even), root)
    versions.publish(sketches.where(~even), root, append=True)
    stored = versions.read_published(stages.transactions.sparkSession, root)
    samples = gas.gas_samples(stages.transactions)
    answers = None
    for q in SKETCH_SHARES:
        merged = gas.sketched_cutoff(stored, q)
        cuts = {
            "cutoff": merged.select("cutoff").scalar(),
            "default": gas.gas_cutoff(stages.transactions, q).scalar(),
        }
        price = F.col("gas_price")
        ranks = samples.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(price <= cut).alias(f"{name}_to") for name, cut in cuts.items()],
            *[F.count_if(price < cut).alias(f"{name}_from") for name, cut in cuts.items()],
        ).withColumn("samples", merged.select("samples").scalar())

        def near(column: str, error: float):
            # A value stands for all ranks that rows equal to it take.
            low, high = (q - error) * F.col("n"), (q + error) * F.col("n") + 1  # noqa: B023
            return (F.col(f"{column}_to") >= low) & (F.col(f"{column}_from") <= high)

        row = ranks.select(
            F.lit(q).alias("q"), "samples",
            near("cutoff", gas.RANK_ERROR).alias("sketch_is_near"), near("default", gas.RANK_ERROR).alias("default_is_near"),
        )
        answers = row if answers is None else answers.unionByName(row)
    return answers


@stage_query
def gas_baseline_hourly(stages: WalletPipeline) -> DataFrame:
    return gas.gas_baseline_hourly(stages.transactions, rel_err=0)


@stage_query
def gas_baseline_within_hour(stages: WalletPipeline) -> DataFrame:
    return gas.gas_baseline_hourly(stages.transactions, scope="hour")


# Distribution ----------------------------------------------------------------------------


@stage_query
def activity_histogram(stages: WalletPipeline) -> DataFrame:
    return distribution.activity_histogram(stages.activity)


@stage_query
def pareto_curve(stages: WalletPipeline) -> DataFrame:
    return distribution.pareto_curve(stages.activity)


@stage_query
def pareto_points(stages: WalletPipeline) -> DataFrame:
    return distribution.pareto_points(distribution.pareto_curve(stages.activity))


# Matrix and ids --------------------------------------------------------------------------


@stage_query
def dense_ids(stages: WalletPipeline) -> DataFrame:
    return matrix.dense_ids(stages.stored_real_portfolios, "user_address", "user_id")


@stage_query
def wallet_universe(stages: WalletPipeline) -> DataFrame:
    return matrix.wallet_universe(stages.processed)


@stage_query
def valid_token_addresses(stages: WalletPipeline) -> DataFrame:
    return matrix.valid_token_addresses(stages.tokens)


@stage_query
def user_map(stages: WalletPipeline) -> DataFrame:
    return stages.user_map


@stage_query
def token_map(stages: WalletPipeline) -> DataFrame:
    return stages.token_map


@stage_query
def index_pairs_left(stages: WalletPipeline) -> DataFrame:
    held = stages.stored_real_portfolios
    users = matrix.dense_ids(held, "user_address", "user_id")
    tokens = matrix.dense_ids(held, "token_address", "token_id")
    return matrix.index_pairs_left(held, users, tokens)


@stage_query
def index_pairs(stages: WalletPipeline) -> DataFrame:
    return stages.indexed_pairs


@stage_query
def index_transfers(stages: WalletPipeline) -> DataFrame:
    return stages.indexed_transfers


@stage_query
def unmapped_count(stages: WalletPipeline) -> DataFrame:
    # Maps of the real wallets only, so that some ends have no id.
    users = matrix.dense_ids(stages.stored_real_portfolios, "user_address", "user_id")
    indexed = matrix.index_transfers(stages.processed, users, stages.token_map)
    return matrix.unmapped_count(indexed)


@stage_query
def sparsity(stages: WalletPipeline) -> DataFrame:
    return matrix.sparsity(stages.stored_real_portfolios, "user_address", "token_address")


@stage_query
def user_totals(stages: WalletPipeline) -> DataFrame:
    return matrix.user_totals(stages.stored_real_portfolios)


@stage_query
def token_holders(stages: WalletPipeline) -> DataFrame:
    return matrix.token_holders(stages.stored_real_portfolios)


@stage_query
def score_pairs(stages: WalletPipeline) -> DataFrame:
    return stages.scored


@stage_query
def threshold_grid(stages: WalletPipeline) -> DataFrame:
    return matrix.threshold_grid(stages.stored_scored)


@stage_query
def filter_pairs(stages: WalletPipeline) -> DataFrame:
    return stages.filtered


@stage_query
def filter_pairs_metrics(stages: WalletPipeline) -> DataFrame:
    return matrix.sparsity(stages.filtered, "user_address", "token_address")


@stage_query
def sparsity_by_id(stages: WalletPipeline) -> DataFrame:
    return matrix.sparsity(stages.indexed_pairs, "user_id", "token_id")


# Graph -----------------------------------------------------------------------------------


@stage_query
def edges(stages: WalletPipeline) -> DataFrame:
    return graph.edges(stages.indexed_transfers)


@stage_query
def vertices(stages: WalletPipeline) -> DataFrame:
    return graph.vertices(stages.edges)


@stage_query
def out_degrees(stages: WalletPipeline) -> DataFrame:
    return graph.out_degrees(stages.edges)


@stage_query
def pagerank(stages: WalletPipeline) -> DataFrame:
    return stages.ranks


def _settled_ranks(stages: WalletPipeline) -> DataFrame:
    # Equal ranks may differ in their last bits; rounding keeps ties ties.
    return rounded(stages.ranks, RANK_DIGITS)


@stage_query
def top_wallets(stages: WalletPipeline) -> DataFrame:
    return graph.top_wallets(_settled_ranks(stages))


@stage_query
def mid_wallets(stages: WalletPipeline) -> DataFrame:
    return graph.mid_wallets(_settled_ranks(stages), k=MID_K)


@stage_query
def low_wallets(stages: WalletPipeline) -> DataFrame:
    return graph.low_wallets(_settled_ranks(stages), k=LOW_K)


@stage_query
def stratified_sample(stages: WalletPipeline) -> DataFrame:
    return graph.stratified_sample(_settled_ranks(stages), TOP_K, MID_K, LOW_K)


# Kept over slices ------------------------------------------------------------------------


def _slices(rows: DataFrame) -> list[DataFrame]:
    """``rows`` cut by date; together they are all of them."""
    first, second = (F.lit(day).cast("date") for day in SLICE_DAYS)
    at = F.col("block_timestamp")
    return [rows.where(at < first), rows.where((at >= first) & (at < second)), rows.where((at >= second) | at.isNull())]


@stage_query
def balances_over_slices(stages: WalletPipeline) -> DataFrame:
    flows = stages.flows
    root = scratch_path(flows.sparkSession, "balances")
    for number, part in enumerate(_slices(flows)):
        balances.add_slice(root, part, str(number), buckets=8)
    return balances.held_balances(versions.read_published(flows.sparkSession, root))


@stage_query
def lasting_ids_over_slices(stages: WalletPipeline) -> DataFrame:
    transfers = stages.stored_normalized
    root = scratch_path(transfers.sparkSession, "ids")
    for part in _slices(transfers):
        lasting_ids.extend_ids(root, matrix.wallet_universe(part), "user_address", "user_id", buckets=8)
    return lasting_ids.id_map(transfers.sparkSession, root)


@stage_query
def ranks_over_slices(stages: WalletPipeline) -> DataFrame:
    transfers = stages.stored_normalized
    root = scratch_path(transfers.sparkSession, "kept-ranks")
    first, second, last = _slices(transfers)
    for number, part in enumerate((first.unionByName(second), last)):
        pairs = matrix.index_ends(graph.wallet_pairs(part), stages.user_map)
        rank_update.add_edges(root, graph.edges(pairs), str(number), tolerance=RANK_TOLERANCE, buckets=8)
    ranks = rank_update.kept_ranks(transfers.sparkSession, root)
    return rank_update.settled(ranks, stages.edges, tolerance=RANK_TOLERANCE)


# Features --------------------------------------------------------------------------------


@stage_query
def correlation_matrix(stages: WalletPipeline) -> DataFrame:
    return features.correlation_matrix(stages.filtered, ["total_tx", "num_holders"])


@stage_query
def minmax_scale(stages: WalletPipeline) -> DataFrame:
    return stages.scores


@stage_query
def attach_scores(stages: WalletPipeline) -> DataFrame:
    return features.attach_scores(stages.indexed_pairs, stages.scores)


@stage_query
def score_coverage(stages: WalletPipeline) -> DataFrame:
    return features.score_coverage(features.attach_scores(stages.indexed_pairs, stages.scores))


@stage_query
def ultimate_confidence(stages: WalletPipeline) -> DataFrame:
    return stages.rated_pairs


@stage_query
def describe_column(stages: WalletPipeline) -> DataFrame:
    return features.describe_column(stages.rated_pairs, "ultimate_confidence")


@stage_query
def frequency_index(stages: WalletPipeline) -> DataFrame:
    columns = {"user_id": "user_id_int", "token_id": "token_id_int"}
    return features.frequency_index(stages.indexed_pairs, columns)


@stage_query
def train_test_split(stages: WalletPipeline) -> DataFrame:
    train, test = features.train_test_split(stages.indexed_pairs, ["user_id", "token_id"])
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


# Recommender and evaluation --------------------------------------------------------------


def popularity_recs(stages: WalletPipeline) -> DataFrame:
    """Input of the metric queries: the most held training items for every test user."""
    train, test = stages.numbered_split
    top = (
        train.groupBy("token_id_int")
        .agg(F.count(F.lit(1)).cast("double").alias("score"))
        .orderBy(F.desc("score"), "token_id_int")
        .limit(POPULAR)
        .agg(F.collect_list(F.struct("token_id_int", "score")).alias("items"))
    )
    users = test.select("user_id_int").distinct()
    return users.withColumn("item", F.explode(top.scalar())).select("user_id_int", "item.*")


@stage_query
def rank_recs(stages: WalletPipeline) -> DataFrame:
    return evaluate.rank_recs(popularity_recs(stages))


@stage_query
def ground_truth(stages: WalletPipeline) -> DataFrame:
    truth = evaluate.ground_truth(stages.numbered_split[1])
    return truth.select(
        "user_id_int", F.array_join("actual_tokens", ",").alias("actual_tokens")
    )


@stage_query
def ranking_metrics(stages: WalletPipeline) -> DataFrame:
    return evaluate.ranking_metrics(
        evaluate.rank_recs(popularity_recs(stages)), stages.numbered_split[1]
    )


@stage_query
def ndcg_at_k(stages: WalletPipeline) -> DataFrame:
    return evaluate.ndcg_at_k(evaluate.rank_recs(popularity_recs(stages)), stages.numbered_split[1])


@stage_query
def catalog_coverage(stages: WalletPipeline) -> DataFrame:
    return evaluate.catalog_coverage(
        evaluate.rank_recs(popularity_recs(stages)), stages.numbered_pairs
    )


@stage_query
def safe_catalog(stages: WalletPipeline) -> DataFrame:
    return stages.safe


@stage_query
def trending_catalog(stages: WalletPipeline) -> DataFrame:
    return stages.trending


@view_query
def route_recommendations(views: SampleViews) -> DataFrame:
    stages = views.pipeline()
    return route.route_recommendations(
        views.requests(),
        stages.numbered_pairs,
        evaluate.rank_recs(popularity_recs(stages)),
        stages.safe,
        stages.trending,
    )


@view_query
def route_wallets(views: SampleViews) -> DataFrame:
    """Requests by address, by id and by names that are neither."""
    stages = views.pipeline()
    root = scratch_path(views.spark, "user-map")
    versions.publish(stages.user_map, root, buckets=versions.Buckets(("user_address",), 8))
    return route.route_wallets(
        views.wallet_requests(),
        versions.read_published(views.spark, root),
        stages.numbered_pairs,
        evaluate.rank_recs(popularity_recs(stages)),
        stages.safe,
        stages.trending,
    )


def _default_model(train: DataFrame) -> ALSModel:
    setting = DEFAULT_SETTING
    return recommend.train_als(train, setting.rank, setting.reg, setting.alpha)


def _sound_factors(factors: DataFrame) -> DataFrame:
    """Per id: how many factors it has, and whether all are finite and none is negative."""
    good = F.forall("features", lambda x: (x >= 0) & (x < float("inf")))
    return factors.select("id", F.size("features").alias("factors"), good.alias("sound"))


# Scores are float sums of products of floats.
SCORE_TOLERANCE = 1e-4


def _checked_recs(recs: DataFrame, model: ALSModel) -> DataFrame:
    """Per user and rank: the score is the factors' product, none rises, no item comes twice."""
    users = model.userFactors.select(F.col("id").alias("user_id_int"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("token_id_int"), F.col("features").alias("i"))
    product = F.aggregate(
        F.zip_with("u", "i", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda total, x: total + x
    )
    # A user has at most as many rows as were asked for.
    by_rank = Window.partitionBy("user_id_int").orderBy("rank")
    by_item = Window.partitionBy("user_id_int", "token_id_int")
    return (
        recs.join(users, "user_id_int")
        .join(items, "token_id_int")
        .withColumn("before", F.lag("score").over(by_rank))
        .withColumn("times", F.count(F.lit(1)).over(by_item))
        .select(
            "user_id_int",
            F.col("rank").cast("int").alias("rank"),
            (F.abs(product - F.col("score")) <= SCORE_TOLERANCE * (1 + F.abs("score"))).alias("is_product"),
            F.coalesce(F.col("score") <= F.col("before"), F.lit(True)).alias("is_ordered"),
            (F.col("times") == 1).alias("is_single"),
        )
    )


@stage_query
def train_als(stages: WalletPipeline) -> DataFrame:
    return _sound_factors(_default_model(stages.split[0]).userFactors)


@stage_query
def certify_model(stages: WalletPipeline) -> DataFrame:
    """Whether each trained user's factors solve what the fit minimises."""
    train = stages.split[0]
    setting = DEFAULT_SETTING
    checked = recommend.certify_model(_default_model(train), train, setting.reg, setting.alpha)
    return checked.select(F.col("id").alias("user_id_int"), "n_pairs", "is_feasible", "is_optimal")


@stage_query
def save_model(stages: WalletPipeline) -> DataFrame:
    path = scratch_path(stages.transfers.sparkSession, "model")
    model = _default_model(stages.split[0])
    recommend.save_model(model, path)
    saved = model.itemFactors.select("id", F.col("features").alias("saved"))
    loaded = recommend.load_model(path).itemFactors
    equal = _sound_factors(loaded).join(loaded, "id").join(saved, "id", "full")
    return equal.select("id", "factors", "sound", (F.col("features") == F.col("saved")).alias("is_equal"))


@stage_query
def select_model(stages: WalletPipeline) -> DataFrame:
    table = recommend.select_model(*stages.split)[1]
    top = table.agg(F.max("ndcg")).scalar()
    chosen = table.agg(F.count_if("best")).scalar()
    sound = (F.col("ndcg") >= 0) & (F.col("ndcg") <= 1) & (~F.col("best") | (F.col("ndcg") == top))
    return table.select("label", "users", (sound & (chosen == 1)).alias("sound"))


@stage_query
def recommend_top_n(stages: WalletPipeline) -> DataFrame:
    train, test = stages.split
    model = _default_model(train)
    return _checked_recs(recommend.recommend_top_n(model, test, 10), model)


@stage_query
def recommend_unseen(stages: WalletPipeline) -> DataFrame:
    """No held item is recommended; the lists stay full as long as items are left."""
    train, test = stages.split
    recs = recommend.recommend_top_n(_default_model(train), test, 10, exclude_seen=train)
    seen = train.select("user_id_int", "token_id_int", F.lit(True).alias("is_seen"))
    return recs.join(seen, ["user_id_int", "token_id_int"], "left").select(
        "user_id_int", F.col("rank").cast("int").alias("rank"), F.coalesce("is_seen", F.lit(False)).alias("is_seen")
    )


@stage_query
def als_ranking_metrics(stages: WalletPipeline) -> DataFrame:
    train, test = stages.split
    metrics = recommend.evaluate_model(_default_model(train), test)
    inside = [F.col(m).between(0, 1) for m in ("precision", "recall", "ndcg", "hit_rate")]
    return metrics.select("k", "users_eval", "users_total", F.array_min(F.array(*inside)).alias("in_range"))


def _routed(answers: DataFrame) -> DataFrame:
    """Rows of a router; those of a model without their items, which no SQL can know."""
    own = F.col("source") == "als"
    return answers.select(
        "user_id",
        "risk_mode",
        F.col("rank").cast("int").alias("rank"),
        "source",
        F.when(~own, F.col("token_id_int")).alias("token_id_int"),
        F.when(~own, F.col("score")).alias("score"),
    )


@view_query
def route_als(views: SampleViews) -> DataFrame:
    stages = views.pipeline()
    model = _default_model(stages.split[0])
    wanted = route.known_wallets(views.requests(), stages.interactions)
    recs = recommend.recommend_top_n(model, wanted, route.TOP_N)
    return _routed(
        route.route_recommendations(
            views.requests(), stages.interactions, recs, stages.safe, stages.trending
        )
    )


@view_query
def recommend_for_user(views: SampleViews) -> DataFrame:
    """One known wallet, and two unknown ones that ask for either catalog."""
    stages = views.pipeline()
    train = stages.split[0]
    model = _default_model(train)
    known = train.agg(F.min("user_id")).first()[0] or -1
    answers = [
        recommend.recommend_for_user(user, model, train, stages.safe, stages.trending, risk_mode=mode)
        for user, mode in ((known, "safe"), (-2, "safe"), (-3, "daring"))
    ]
    return _routed(answers[0].unionByName(answers[1]).unionByName(answers[2]))
