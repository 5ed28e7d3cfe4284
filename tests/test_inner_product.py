"""The pruned search against a scan of everything."""

from __future__ import annotations

import numpy as np
import pytest

from walletlens.operators import inner_product
from walletlens.operators.inner_product import top_inner_products

VECTORS = "id int, features array<float>"


def table(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, VECTORS)


def by_scan(queries, items, k, held=()):
    """All products of float vectors in double precision; ties by id."""
    out = {}
    for q, vector in enumerate(queries):
        products = items.astype(np.float64) @ vector.astype(np.float64)
        kept = [i for i in range(len(items)) if (q, i) not in held]
        out[q] = sorted(kept, key=lambda i: (-products[i], i))[:k]
    return out


def found(result):
    return {r["query"]: list(r["found"]) for r in result.collect()}


def random_vectors(n, width, seed, steps=None):
    draw = np.random.default_rng(seed)
    lengths = draw.pareto(1.5, (n, 1)) + 0.1
    values = draw.random((n, width)) * lengths
    return (np.round(values * steps) / steps if steps else values).astype(np.float32)


@pytest.mark.parametrize("block_items", [7, 100, 65_536])
def test_search_equals_scan(spark, block_items):
    queries, items = random_vectors(60, 5, 1), random_vectors(300, 5, 2)
    result = top_inner_products(table(spark, queries), table(spark, items), 6, block_items=block_items)
    assert found(result) == by_scan(queries, items, 6)
    for r in result.collect():
        assert np.allclose(r["scores"], queries[r["query"]].astype(float) @ items[list(r["found"])].astype(float).T)


def test_ties_and_zero_vectors(spark):
    queries = np.vstack([random_vectors(10, 3, 3, steps=1), np.zeros((2, 3))]).astype(np.float32)
    items = np.vstack([random_vectors(40, 3, 4, steps=1), np.zeros((5, 3)), np.ones((5, 3))]).astype(np.float32)
    for block_items in (4, 1000):
        result = top_inner_products(table(spark, queries), table(spark, items), 8, block_items=block_items)
        assert found(result) == by_scan(queries, items, 8)


@pytest.mark.parametrize("block_items", [16, 65_536])
def test_held_items_are_passed_over(spark, block_items):
    queries, items = random_vectors(20, 4, 5), random_vectors(150, 4, 6)
    draw = np.random.default_rng(7)
    held = {(0, i) for i in range(150)}  # one holds everything
    held |= {(1, i) for i in range(147)}  # one all but three
    held |= {(int(q), int(i)) for q, i in zip(draw.integers(2, 25, 400), draw.integers(0, 160, 400))}
    pairs = spark.createDataFrame([*held, *list(held)[:50]], "query int, item int")
    result = top_inner_products(table(spark, queries), table(spark, items), 5, pairs, block_items)
    assert found(result) == by_scan(queries, items, 5, held)


def test_most_queries_need_one_block(spark, monkeypatch):
    rounds = []
    kept = inner_product._searched
    monkeypatch.setattr(inner_product, "_searched", lambda *a: rounds.append(1) or kept(*a))
    items = np.vstack([random_vectors(50, 4, 8) + 10, random_vectors(5000, 4, 9) / 1000]).astype(np.float32)
    queries = random_vectors(30, 4, 10)
    result = top_inner_products(table(spark, queries), table(spark, items), 5, block_items=50)
    assert found(result) == by_scan(queries, items, 5)
    assert len(rounds) == 1


def test_empty_sides(spark):
    some, none = table(spark, random_vectors(3, 2, 11)), spark.createDataFrame([], VECTORS)
    assert top_inner_products(none, some, 3).collect() == []
    assert found(top_inner_products(some, none, 3)) == {0: [], 1: [], 2: []}
    assert found(top_inner_products(some, some.limit(1), 3)) == {0: [0], 1: [0], 2: [0]}


def test_no_product_of_all_pairs_is_planned(spark):
    queries, items = table(spark, random_vectors(30, 4, 1)), table(spark, random_vectors(50, 4, 2))
    seen = []
    stored = inner_product.written

    def spied(df, label="stage"):
        seen.append(df._jdf.queryExecution().toString())
        return stored(df, label)

    inner_product.written = spied
    try:
        top_inner_products(queries, items, 3, spark.createDataFrame([(1, 2)], "query int, item int")).collect()
    finally:
        inner_product.written = stored
    assert seen and not any("Cartesian" in p or "NestedLoop" in p for p in seen)
