from __future__ import annotations

import random

import pytest
from conftest import rows

from walletlens import schemas
from walletlens.operators import graph

SINK = [(1, 2), (1, 3), (2, 3), (4, 1), (5, 5), (None, 1), (2, 3), (3, None)]


def indexed(spark, pairs):
    data = [(a, b, 1, 1.0) for a, b in pairs]
    return spark.createDataFrame(data, schemas.INDEXED_TRANSFERS)


def edge_list(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def brute_force(pairs, rounds=5, damping=0.85):
    nodes = {n for pair in pairs for n in pair}
    degree = {n: sum(1 for s, _ in pairs if s == n) for n in nodes}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        inflow = dict.fromkeys(nodes, 0.0)
        for src, dst in pairs:
            inflow[dst] += rank[src] / degree[src]
        rank = {n: (1 - damping) + damping * inflow[n] for n in nodes}
    return rank


def test_edges_and_degrees(spark):
    edges = graph.edges(indexed(spark, SINK))
    assert rows(edges) == [(1, 2), (1, 3), (2, 3), (4, 1)]
    assert rows(graph.vertices(edges)) == [(1,), (2,), (3,), (4,)]
    assert rows(graph.out_degrees(edges)) == [(1, 2), (2, 1), (4, 1)]
    pairs = spark.createDataFrame([("A", "b"), ("a", "B")], "from_address string, to_address string")
    assert rows(graph.wallet_pairs(pairs)) == [("a", "b")]


def test_pagerank_with_sink(spark):
    edges = graph.edges(indexed(spark, SINK))
    got = dict(rows(graph.pagerank(edges)))
    want = brute_force([(1, 2), (1, 3), (2, 3), (4, 1)])
    assert got == pytest.approx(want)
    assert got[4] == pytest.approx(0.15)
    assert sum(got.values()) < 4


def test_pagerank_without_sink_keeps_the_mass(spark):
    ring = [(i, (i + 1) % 50) for i in range(50)] + [(0, 7), (3, 11)]
    got = dict(rows(graph.pagerank(edge_list(spark, ring))))
    assert sum(got.values()) == pytest.approx(50)
    assert min(got.values()) >= 0.15


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("min_hub_degree", [5, 10_000])
def test_pagerank_with_hubs(spark, broadcast, min_hub_degree):
    random.seed(5)
    # One sender and one receiver have a third of all edges each.
    pairs = {(0, n) for n in range(1, 301)} | {(n, 1) for n in range(301, 601)}
    pairs |= {(random.randrange(600), random.randrange(600)) for _ in range(300)}
    pairs = sorted((a, b) for a, b in pairs if a != b)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = dict(
            rows(graph.pagerank(edge_list(spark, pairs), iterations=7, min_hub_degree=min_hub_degree))
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == pytest.approx(brute_force(pairs, rounds=7))


def test_pagerank_of_nothing(spark):
    assert graph.pagerank(edge_list(spark, [])).count() == 0


def test_samples(spark):
    data = [(i, r) for i, r in enumerate([9.0, 1.0, 1.0, 0.9, 0.15, 0.15, 0.15, 5.0])]
    ranks = spark.createDataFrame(data, schemas.RANKS)
    assert [r.id for r in graph.top_wallets(ranks, 2).collect()] == [0, 7]
    assert [r.id for r in graph.low_wallets(ranks, 2).collect()] == [4, 5]
    # The mean is about 2.2, so nothing lies around it; a flat ranking lies wholly around it.
    assert graph.mid_wallets(ranks).count() == 0
    flat = spark.createDataFrame([(i, 0.15) for i in range(10)], schemas.RANKS)
    assert [r.id for r in graph.mid_wallets(flat, k=3).collect()] == [0, 1, 2]
    assert rows(graph.stratified_sample(flat, 2, 4, 3), "id", "tier") == [
        (0, "top"), (1, "top"), (2, "mid"), (3, "mid"),
    ]
    assert graph.stratified_sample(ranks).count() == 8


def test_pagerank_shares_what_sinks_lose(spark):
    pairs = [(1, 2), (1, 3), (2, 3), (4, 1)]
    nodes = {n for pair in pairs for n in pair}
    degree = {n: sum(1 for s, _ in pairs if s == n) for n in nodes}
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(4):
        inflow = dict.fromkeys(nodes, sum(rank[n] for n in nodes if not degree[n]) / len(nodes))
        for src, dst in pairs:
            inflow[dst] += rank[src] / degree[src]
        rank = {n: 0.15 + 0.85 * inflow[n] for n in nodes}
    got = dict(rows(graph.pagerank(edge_list(spark, pairs), iterations=4, redistribute_sinks=True)))
    assert got == pytest.approx(rank)
    assert sum(got.values()) == pytest.approx(4)


def test_pagerank_keeps_the_callers_settings(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    graph.pagerank(edge_list(spark, [(1, 2), (2, 1)]))
    assert spark.conf.get(key) == before
