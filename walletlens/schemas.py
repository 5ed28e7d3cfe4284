"""Declared schemas of the raw and derived tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, INT, DOUBLE = StringType(), LongType(), IntegerType(), DoubleType()
BOOLEAN, TIMESTAMP = BooleanType(), TimestampType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


RAW_TRANSACTIONS = _table(
    hash=STRING,
    from_address=STRING,
    to_address=STRING,
    value=DecimalType(38, 9),
    block_timestamp=TIMESTAMP,
    gas_price=LONG,
    receipt_status=INT,
)
TRANSACTIONS = _table(
    hash=STRING,
    from_address=STRING,
    to_address=STRING,
    eth_value=DOUBLE,
    block_timestamp=TIMESTAMP,
    gas_price=LONG,
)
TOKENS = _table(address=STRING, symbol=STRING, name=STRING, decimals=STRING, total_supply=STRING)
TRANSFERS = _table(
    token_address=STRING,
    from_address=STRING,
    to_address=STRING,
    value=STRING,
    transaction_hash=STRING,
    block_timestamp=TIMESTAMP,
)
RAW_CONTRACTS = _table(
    address=STRING, is_erc20=BOOLEAN, is_erc721=BOOLEAN, block_timestamp=TIMESTAMP
)
CONTRACTS = _table(address=STRING, is_erc20=BOOLEAN, is_erc721=BOOLEAN)
PROCESSED_TRANSFERS = _table(
    from_address=STRING, to_address=STRING, token_address=STRING, adjusted_value=DOUBLE
)
PORTFOLIOS = _table(
    user_address=STRING,
    token_address=STRING,
    balance=DOUBLE,
    tx_count=LONG,
    last_active=TIMESTAMP,
    is_contract=BOOLEAN,
)
SCORED_PAIRS = _table(
    user_address=STRING, token_address=STRING, total_tx=LONG, num_holders=LONG
)
USER_MAP = _table(user_address=STRING, user_id=LONG)
TOKEN_MAP = _table(token_address=STRING, token_id=LONG)
INDEXED_PAIRS = _table(user_id=LONG, token_id=LONG, total_tx=LONG, num_holders=LONG)
INDEXED_TRANSFERS = _table(
    from_user_id=LONG, to_user_id=LONG, token_id=LONG, adjusted_value=DOUBLE
)
RANKS = _table(id=LONG, pagerank=DOUBLE)
REQUESTS = _table(user_id=STRING, risk_mode=STRING)
