"""Wallet-shaped views over the benchmark tables, so that every query has real input.

Amounts come out as whole numbers, which keeps balances exact in double arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from walletlens.plans.pipeline import Settings, WalletPipeline

# Thresholds scaled to the size of the benchmark tables.
SAMPLE_SETTINGS = Settings(
    exchange_tx_limit=40,
    min_tx=20,
    min_holders=10,
    safe_min_holders=20,
    trending_low=10,
    trending_high=25,
)


def address(key: str) -> Column:
    """A 20-byte hex address made from an integer expression."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.expr(key))), 40, "0"))


class SampleViews:
    """The raw tables of the pipeline, derived from the tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def tokens(self) -> DataFrame:
        return self._table("part").select(
            address("p_partkey").alias("address"),
            F.col("p_brand").alias("symbol"),
            F.col("p_name").alias("name"),
            F.col("p_size").alias("decimals"),
            F.expr("cast(cast(round(p_retailprice * 100) as bigint) as string)").alias(
                "total_supply"
            ),
        )

    def transfers(self) -> DataFrame:
        lines = self._table("lineitem")
        orders = self._table("orders").select("o_orderkey", "o_custkey")
        parts = self._table("part").select("p_partkey", "p_size")
        amount = F.expr(
            "concat(cast(cast(l_quantity as bigint) as string), repeat('0', p_size), "
            "case when l_linenumber = 7 then repeat('0', 40) else '' end)"
        )
        return (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                address("l_partkey").alias("token_address"),
                address("o_custkey").alias("from_address"),
                address("l_suppkey * 10 + l_linenumber").alias("to_address"),
                amount.alias("value"),
                address("l_orderkey").alias("transaction_hash"),
                F.col("l_shipdate").alias("block_timestamp"),
            )
        )

    def raw_contracts(self) -> DataFrame:
        """The wallets that count as contracts here: those of one market segment."""
        return self._contracts(self._table("customer").filter(F.col("c_mktsegment") == "MACHINERY"))

    def all_contracts(self) -> DataFrame:
        """The same columns for the whole table, for steps that have no need of a choice."""
        return self._contracts(self._table("customer"))

    def _contracts(self, customers: DataFrame) -> DataFrame:
        return customers.select(
            address("c_custkey").alias("address"),
            (F.col("c_nationkey") % 2 == 0).alias("is_erc20"),
            (F.col("c_nationkey") % 5 == 0).alias("is_erc721"),
            F.expr("date_add(date '2022-06-01', cast(c_custkey as int))").alias("block_timestamp"),
        )

    def fractional_transfers(self) -> DataFrame:
        """Transfers whose amounts are fractions, each with its return to the sender for every third line."""
        lines = self._table("lineitem")
        orders = self._table("orders").select("o_orderkey", "o_custkey")
        there = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            address("l_partkey").alias("token_address"),
            address("o_custkey").alias("from_address"),
            address("l_suppkey * 10 + l_linenumber").alias("to_address"),
            F.expr("cast(cast(round(l_extendedprice * 100) as bigint) as string)").alias("value"),
            address("l_orderkey").alias("transaction_hash"),
            F.col("l_shipdate").alias("block_timestamp"),
            "l_linenumber",
        )
        back = there.filter("l_linenumber % 3 = 0").select(
            "token_address", F.col("to_address").alias("from_address"), F.col("from_address").alias("to_address"),
            "value", "transaction_hash", "block_timestamp", "l_linenumber",
        )
        return there.unionByName(back).drop("l_linenumber")

    def raw_transactions(self) -> DataFrame:
        value = F.expr(
            "cast(concat(cast(cast(round(value * 100) as bigint) as string), repeat('0', 16)) "
            "as decimal(38,9))"
        )
        return self._table("events").select(
            address("event_id").alias("hash"),
            address("user_id").alias("from_address"),
            F.when(F.col("event_id") % 97 != 0, address("event_id % 100")).alias("to_address"),
            value.alias("value"),
            F.col("ts").alias("block_timestamp"),
            F.col("value").alias("gas_price"),
            F.when(F.col("event_type") == "error", 0).otherwise(1).alias("receipt_status"),
        )

    def transactions(self) -> DataFrame:
        return self.raw_transactions().select("from_address", "block_timestamp", "gas_price")

    def requests(self) -> DataFrame:
        """Recommendation requests: some ids have history and some do not."""
        mode = F.expr(
            "case when c_nationkey % 2 = 0 then 'safe' "
            "when c_nationkey % 3 = 0 then null else 'daring' end"
        )
        return self._table("customer").select(
            F.col("c_custkey").cast("string").alias("user_id"), mode.alias("risk_mode")
        )

    def wallet_requests(self) -> DataFrame:
        """The same requests by other names: addresses in either case, ids, and names of nothing."""
        wallet = F.expr("case c_custkey % 4 when 0 then concat(' ', upper(at)) when 1 then at "
                        "when 2 then cast(c_custkey as string) else concat('wallet ', c_custkey) end")  # fmt: skip
        modes = self.requests().select(F.col("user_id").cast("long").alias("c_custkey"), "risk_mode")
        return modes.withColumn("at", address("c_custkey")).select(wallet.alias("wallet"), "risk_mode")

    def pipeline(self, settings: Settings = SAMPLE_SETTINGS) -> WalletPipeline:
        return WalletPipeline(
            self.transfers, self.tokens, self.raw_contracts, self.transactions, settings
        )
