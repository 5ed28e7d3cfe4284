"""Every registered query with SQL against DuckDB, and plan checks over all of them."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from walletlens.plans import oracle  # noqa: E402
from walletlens.plans.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# Top-k lists of a model multiply blocks of factors: the one product of blocks that is allowed.
MODEL_QUERIES = {
    "select_model", "recommend_top_n", "recommend_unseen", "als_ranking_metrics", "route_als", "recommend_for_user",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are absent")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.fixture
def without_broadcast(spark):
    """Plan as for tables too large to broadcast, unless a bound is built in."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def check_plan(result, products=0):
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert len(re.findall(r"\bCartesianProduct\b", plan)) <= products
    # A window without a partition may only see the one total per range.
    for window in re.findall(r"Window \[.*", plan):
        assert "_range" in window or "user_id_int" in window


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, duck, without_broadcast, name):
    result = QUERIES[name](spark, FOLDER)
    # Each of the single-wallet calls of one query has its own list.
    check_plan(result, products=3 * (name in MODEL_QUERIES))
    verdict = compare(result, duck, oracle.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["user_address", "token_address", "balance", "tx_count", "last_active"]
    assert result.count() == 1702
