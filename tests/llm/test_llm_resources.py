"""Operators read their texts once where they can, and no task needs more Python workers than one."""

from __future__ import annotations

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from walletlens import session  # noqa: E402
from walletlens.llm import decontaminate, jaccard_join, quality_classifier, suffix_dedup  # noqa: E402


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_leaks_are_found_by_one_reading_and_without_chained_workers(spark):
    item = "the copper heron walked along the narrow pier while seven grey ships waited for the evening tide"
    filler = [(k, f"plain filler number {k} about nothing that anyone would ever ask in a test") for k in range(20)]
    docs = spark.createDataFrame([*filler, (99, f"before it {item} and after it"), (100, None)], "doc_id long, text string")
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame([(5, item)], "item_id long, text string"))
    # What is left to do when the texts have been read is the check of places that share a run.
    assert plan_of(leaks).count("MapInArrow") == 1
    assert [(r["doc_id"], r["item_id"], r["common_share"]) for r in leaks.collect()] == [(99, 5, 1.0)]


def test_many_segments_of_one_anchor_send_on_no_row_for_each_string(spark, monkeypatch):
    """A passage of 300 bytes in 200 different texts: nothing repeats, so hardly anything may be sent on."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 16)
    rng = random.Random(11)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = letters(300)
    texts = [letters(500) + passage + letters(500) for _ in range(200)]
    texts += [f"{texts[0][300:1000]}#{letters(50)}", f"{texts[1][450:850]}#"]  # 700 and 400 bytes of others
    stored, kept = [], suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, label: stored.append((label, kept(df, label))) or stored[-1][1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(docs).collect() if r["n_removed"]}
    assert gone == {0: (700, 1), 200: (700, 1), 1: (400, 1), 201: (400, 1)}
    # Every row after the first cut; a row for each string of the passage's segments would make tens of thousands.
    rows = [(label, df.count()) for label, df in stored if label not in ("kinds", "cuts", "spans")][1:]
    assert sum(n for _, n in rows) < 4_000, rows


def test_sets_without_an_equal_minimum_hash_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    common, one = text(30), text(200)
    docs = [(k, " ".join(common + text(60))) for k in range(30)]  # they share shingles, but link with none
    docs += [(100, " ".join(one)), (101, " ".join(one[:-3]))]
    plans, kept = [], jaccard_join._linked_groups
    monkeypatch.setattr(jaccard_join, "_linked_groups", lambda rows, *a, **k: plans.append(plan_of(rows)) or kept(rows, *a, **k))
    found = jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {k: 100 if k == 101 else k for k, _ in docs}
    # In both preparing rounds a filter stands before the first exchange of sets.
    assert len(plans) == 3 and all("pythonUDF" in plan for plan in plans[:2])


def test_a_small_driver_gets_no_tables_of_hashes(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame([*enumerate(texts), *enumerate(texts[:20], 100)], "doc_id long, text string")
    monkeypatch.setattr(session, "driver_heap", lambda spark: 1 << 17, raising=False)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        found = jaccard_join.near_duplicates(docs)
        assert "SortMergeJoin" in plan_of(found) and "BroadcastHashJoin" not in plan_of(found)
        groups = {r["doc_id"]: r["component_id"] for r in found.collect()}
        assert groups == {k: k % 100 for k in [*range(40), *range(100, 120)]}
        spark.conf.set(key, "5MB")
        session.bound_broadcasts(spark)
        assert spark.conf.get(key) == "5MB"
    finally:
        spark.conf.set(key, old)


def test_training_examples_reach_the_driver_packed(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(400)) for _ in range(60)]
    texts += ["", None, "one", "é \x00 ü"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(len(texts))], "doc_id long, quality int")
    seen, kept = [], quality_classifier.train
    monkeypatch.setattr(quality_classifier, "train", lambda examples, seed: seen.append(examples) or kept(examples, seed))
    model = quality_classifier.fit_quality_model(docs, labels)
    [examples] = seen
    used = [k for k in range(len(texts)) if quality_classifier.zlib.crc32(str(k).encode()) % 5]
    plain = [(*quality_classifier.document_features(texts[k]), k % 2) for k in used]
    assert len(examples) == len(plain)
    for (rows, shares, label), (r, s, c) in zip(examples, plain):
        assert label == c and rows.dtype == r.dtype and shares.dtype == s.dtype
        assert np.array_equal(rows, r) and np.array_equal(shares, s)
    assert 3 * sum(len(data) for data, _ in examples.pairs) < sum(r.nbytes + s.nbytes for r, s, _ in plain)
    # The model is the one of the plain examples, bit by bit.
    whole = quality_classifier.condensed(*kept(plain, 7))
    assert np.array_equal(model.gain, whole.gain) and model.bias == whole.bias
