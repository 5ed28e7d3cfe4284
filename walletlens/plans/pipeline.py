"""The batch pipeline from raw transfers to recommendations.

Every property is one stage. Stages that are read more than once, or that feed a join as
the small side, are stored in the shared folder; the others stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from walletlens.functions.shared_storage import written
from walletlens.operators import clean, features, gas, graph, matrix, portfolio, recommend, route
from walletlens.sources.tables import write_table

# A raw table, or a function that opens it when a stage first needs it.
Source = DataFrame | Callable[[], DataFrame]


@dataclass(frozen=True)
class Settings:
    """Thresholds of a run."""

    max_decimals: int = clean.MAX_DECIMALS
    exchange_tx_limit: int = portfolio.EXCHANGE_TX_LIMIT
    min_tx: int = matrix.MIN_TX
    min_holders: int = matrix.MIN_HOLDERS
    iterations: int = graph.ITERATIONS
    damping: float = graph.DAMPING
    safe_min_holders: int = route.SAFE_MIN_HOLDERS
    trending_low: int = route.TRENDING_LOW
    trending_high: int = route.TRENDING_HIGH
    train_share: float = features.TRAIN_SHARE
    seed: int = features.SEED


class WalletPipeline:
    """All stages over one set of raw tables."""

    def __init__(
        self,
        transfers: Source,
        tokens: Source,
        contracts: Source,
        transactions: Source,
        settings: Settings | None = None,
    ):
        self._sources = {
            "transfers": transfers,
            "tokens": tokens,
            "contracts": contracts,
            "transactions": transactions,
        }
        self.settings = settings or Settings()

    def _source(self, name: str) -> DataFrame:
        source = self._sources[name]
        return source() if callable(source) else source

    @cached_property
    def transfers(self) -> DataFrame:
        return self._source("transfers")

    @cached_property
    def raw_tokens(self) -> DataFrame:
        return self._source("tokens")

    @cached_property
    def raw_contracts(self) -> DataFrame:
        return self._source("contracts")

    @cached_property
    def transactions(self) -> DataFrame:
        return self._source("transactions")

    # Clean and portfolio ---------------------------------------------------------------

    @cached_property
    def tokens(self) -> DataFrame:
        return clean.clean_tokens(self.raw_tokens, self.settings.max_decimals)

    @cached_property
    def stored_tokens(self) -> DataFrame:
        return written(self.tokens, "tokens")

    @cached_property
    def normalized(self) -> DataFrame:
        return clean.normalize_transfers(self.transfers, self.stored_tokens)

    @cached_property
    def stored_normalized(self) -> DataFrame:
        # The one pass over raw transfers; flows, the wallet map and the index read this.
        table = clean.normalize_transfers(self.transfers, self.stored_tokens, keep_amount=True)
        columns = ("from_address", "to_address", "token_address", "adjusted_value", "amount", "decimals")
        return written(table.select(*columns, "block_timestamp"), "normalized")

    @cached_property
    def processed(self) -> DataFrame:
        return clean.processed_transfers(self.stored_normalized)

    @cached_property
    def flows(self) -> DataFrame:
        return portfolio.signed_flows(self.stored_normalized)

    @cached_property
    def portfolios(self) -> DataFrame:
        return portfolio.portfolios(self.flows)

    @cached_property
    def stored_portfolios(self) -> DataFrame:
        return written(self.portfolios, "portfolios")

    @cached_property
    def contracts(self) -> DataFrame:
        return written(portfolio.contract_addresses(self.raw_contracts), "contracts")

    @cached_property
    def labelled(self) -> DataFrame:
        return portfolio.label_contracts(self.stored_portfolios, self.contracts)

    @cached_property
    def real_users(self) -> DataFrame:
        totals = portfolio.wallet_totals(self.stored_portfolios)
        return portfolio.real_users(
            portfolio.label_contracts(totals, self.contracts), self.settings.exchange_tx_limit
        )

    @cached_property
    def real_portfolios(self) -> DataFrame:
        users = written(self.real_users, "real-users")
        return portfolio.real_portfolios(self.stored_portfolios, users)

    @cached_property
    def stored_real_portfolios(self) -> DataFrame:
        return written(self.real_portfolios, "real-portfolios")

    @cached_property
    def activity(self) -> DataFrame:
        return portfolio.user_activity(self.stored_real_portfolios)

    # Gas -------------------------------------------------------------------------------

    @cached_property
    def user_gas_hourly(self) -> DataFrame:
        return gas.user_gas_hourly(self.transactions, self.stored_real_portfolios)

    # Matrix and ids --------------------------------------------------------------------

    @cached_property
    def scored(self) -> DataFrame:
        return matrix.score_pairs(self.stored_real_portfolios)

    @cached_property
    def stored_scored(self) -> DataFrame:
        return written(self.scored, "scored")

    @cached_property
    def filtered(self) -> DataFrame:
        return matrix.filter_pairs(
            self.stored_scored, self.settings.min_tx, self.settings.min_holders
        )

    @cached_property
    def user_map(self) -> DataFrame:
        return matrix.dense_ids(
            matrix.wallet_universe(self.processed), "user_address", "user_id"
        )

    @cached_property
    def token_map(self) -> DataFrame:
        return matrix.dense_ids(
            matrix.valid_token_addresses(self.stored_tokens), "token_address", "token_id"
        )

    @cached_property
    def indexed_pairs(self) -> DataFrame:
        return matrix.index_pairs(self.filtered, self.user_map, self.token_map)

    @cached_property
    def indexed_transfers(self) -> DataFrame:
        return matrix.index_transfers(self.processed, self.user_map, self.token_map)

    # Graph -----------------------------------------------------------------------------

    @cached_property
    def edges(self) -> DataFrame:
        pairs = graph.wallet_pairs(self.processed)
        return graph.edges(matrix.index_ends(pairs, self.user_map))

    @cached_property
    def ranks(self) -> DataFrame:
        return graph.pagerank(self.edges, self.settings.iterations, self.settings.damping)

    # Features and recommendations ------------------------------------------------------

    @cached_property
    def scores(self) -> DataFrame:
        return features.pagerank_scores(self.ranks)

    @cached_property
    def rated_pairs(self) -> DataFrame:
        return features.ultimate_confidence(
            features.attach_scores(self.indexed_pairs, self.scores)
        )

    @cached_property
    def numbered_pairs(self) -> DataFrame:
        """Pairs with the recommender's own ids; catalogs and popularity need no ratings, and so no ranks."""
        pairs = written(self.indexed_pairs, "indexed-pairs")
        columns = {"user_id": "user_id_int", "token_id": "token_id_int"}
        return written(features.frequency_index(pairs, columns), "numbered-pairs")

    @cached_property
    def interactions(self) -> DataFrame:
        """Rated pairs with the recommender's own ids; stored, as every model reads them."""
        scored = features.attach_scores(self.numbered_pairs, self.scores)
        return written(features.ultimate_confidence(scored), "interactions")

    @cached_property
    def numbered_split(self) -> tuple[DataFrame, DataFrame]:
        """The same rows as in ``split``, without ratings."""
        return features.train_test_split(
            self.numbered_pairs, ["user_id", "token_id"], self.settings.train_share, self.settings.seed
        )

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return features.train_test_split(
            self.interactions,
            ["user_id", "token_id"],
            self.settings.train_share,
            self.settings.seed,
        )

    @cached_property
    def safe(self) -> DataFrame:
        return route.safe_catalog(self.numbered_pairs, self.settings.safe_min_holders)

    @cached_property
    def trending(self) -> DataFrame:
        return route.trending_catalog(
            self.numbered_pairs, self.settings.trending_low, self.settings.trending_high
        )

    def export(self, folder: str, n_files: int | None = None) -> dict[str, str]:
        """Write every result table below ``folder``; returns name to path."""
        tables = {
            "processed_tokens": self.stored_tokens,
            "processed_transfers": self.processed,
            "real_portfolios": self.stored_real_portfolios,
            "user_gas_hourly": self.user_gas_hourly,
            "gas_baseline_hourly": gas.gas_baseline_hourly(self.transactions),
            "filtered_pairs": self.filtered,
            "user_map": self.user_map,
            "token_map": self.token_map,
            "indexed_pairs": self.indexed_pairs,
            "indexed_transfers": self.indexed_transfers,
            "ranks": self.ranks,
            "wallet_sample": graph.stratified_sample(self.ranks),
            "safe_tokens": self.safe,
            "trending_tokens": self.trending,
        }
        paths = {name: f"{folder}/{name}" for name in tables}
        for name, table in tables.items():
            write_table(table, paths[name], n_files=n_files)
        return paths

    def export_model(
        self,
        folder: str,
        grid: Sequence[recommend.AlsSetting] = recommend.MODEL_GRID,
        max_iter: int = recommend.MAX_ITER,
    ) -> dict[str, str]:
        """Choose a model on the split and write it, the choice and its metrics below ``folder``."""
        train, test = self.split
        model, choice = recommend.select_model(train, test, grid, max_iter=max_iter)
        paths = {name: f"{folder}/{name}" for name in ("model", "model_choice", "ranking_metrics")}
        recommend.save_model(model, paths["model"])
        write_table(choice, paths["model_choice"])
        write_table(recommend.evaluate_model(model, test), paths["ranking_metrics"])
        return paths
