"""Ranks kept over slices against ranks of all edges."""

from __future__ import annotations

import random

import pytest

from walletlens.operators import rank_update
from walletlens.sources import versions

from conftest import rows
from test_graph import brute_force, edge_list


def kept(spark, root):
    return dict(rows(rank_update.kept_ranks(spark, root)))


@pytest.fixture(scope="module")
def slices():
    """A third of all edges leave wallet 0; slices repeat older edges, and 900 follows no one."""
    random.seed(8)
    ends = lambda: (random.randrange(120), random.randrange(120))
    hub = [(0, n) for n in random.sample(range(1, 120), 90)]
    pairs = hub + [pair for pair in (ends() for _ in range(200)) if pair[0] != pair[1]] + [(5, 900)]
    random.shuffle(pairs)
    return [pairs[:150], pairs[100:220], pairs[220:] + pairs[:20]]


@pytest.mark.parametrize("piece_edges", [10, 1_000_000])
def test_slices_tend_to_the_ranks_of_all_edges(spark, tmp_path, slices, piece_edges):
    root, tolerance = str(tmp_path / "ranks"), 0.02
    seen = set()
    for number, pairs in enumerate(slices):
        extra = [(7, 7), (None, 3), (3, None)]
        rank_update.add_edges(
            root, edge_list(spark, pairs + extra), str(number), tolerance=tolerance, buckets=4, piece_edges=piece_edges
        )
        seen |= set(pairs)
        want, got = brute_force(sorted(seen), rounds=150), kept(spark, root)
        assert got.keys() == want.keys()
        assert sum(abs(got[n] - want[n]) for n in want) <= len(want) * tolerance / 0.15
        state = versions.read_published(spark, f"{root}/state")
        assert state.where(f"abs(residual) > {tolerance}").count() == 0
        assert sum(d for (d,) in rows(state, "out_degree")) == len(seen)
        # The stored residual is the true one: it is what one more round adds to the estimate.
        kept_rows = {r["id"]: r for r in state.collect()}
        inflow = dict.fromkeys(kept_rows, 0.0)
        for src, dst in seen:
            inflow[dst] += kept_rows[src]["pagerank"] / kept_rows[src]["out_degree"]
        for n, row in kept_rows.items():
            assert row["residual"] == pytest.approx(0.15 + 0.85 * inflow[n] - row["pagerank"], abs=1e-9)
    check = rank_update.settled(rank_update.kept_ranks(spark, root), edge_list(spark, sorted(seen)), tolerance=tolerance)
    assert all(row["is_settled"] for row in check.collect())
    assert len(rank_update.compact_edges(spark, root).folders) == 1
    rank_update.add_edges(root, edge_list(spark, [(1, 2000)]), "late", tolerance=tolerance, piece_edges=piece_edges)
    want = brute_force(sorted(seen | {(1, 2000)}), rounds=150)
    got = kept(spark, root)
    assert sum(abs(got[n] - want[n]) for n in want) <= len(want) * tolerance / 0.15


def test_a_small_slice_reaches_few_wallets(spark, tmp_path):
    root = str(tmp_path / "ranks")
    rings = [(10 * r + i, 10 * r + (i + 1) % 10) for r in range(100) for i in range(10)]
    first = rank_update.add_edges(root, edge_list(spark, rings), "a", tolerance=0.05, buckets=4)
    assert first.notes["pushed"] >= 1000
    second = rank_update.add_edges(root, edge_list(spark, [(0, 5)]), "b", tolerance=0.05)
    assert 0 < second.notes["pushed"] < 150
    assert rows(rank_update.kept_ranks(spark, root).where("id >= 10")) == rows(
        versions.read_published(spark, f"{root}/state", first.number).where("id >= 10"), "id", "pagerank"
    )


def test_repeated_failed_and_empty_slices(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "ranks")
    empty = rank_update.add_edges(root, edge_list(spark, []), "none", buckets=2)
    assert kept(spark, root) == {} and empty.notes["rounds"] == 0
    with monkeypatch.context() as broken:
        broken.setattr(rank_update, "_reached", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rank_update.add_edges(root, edge_list(spark, [(1, 2), (2, 3)]), "x")
        with pytest.raises(ValueError):
            rank_update.compact_edges(spark, root)
    version = rank_update.add_edges(root, edge_list(spark, [(1, 2), (2, 3)]), "x")
    assert rank_update.add_edges(root, edge_list(spark, [(8, 9)]), "x").number == version.number
    assert kept(spark, root) == pytest.approx(brute_force([(1, 2), (2, 3)], rounds=9), abs=0.01)


def test_edges_and_state_are_not_exchanged(spark, tmp_path):
    root = str(tmp_path / "ranks")
    pairs = [(i % 50, i % 37 + 50) for i in range(500)]
    rank_update.add_edges(root, edge_list(spark, pairs), "a", tolerance=0.05, buckets=4)
    (part,) = versions.read_folders(spark, versions.current_version(spark, f"{root}/edges"))
    senders = spark.createDataFrame([(1, 10, 0.5)], "src long, out_degree long, share double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rank_update._outgoing(senders, [part], "out_degree", 100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1  # the senders'
