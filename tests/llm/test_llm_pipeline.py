"""The pipeline's stages on nulls, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from walletlens.llm import common, decontaminate, mixing

CLASHING = (
    "doc_id long, text string, source string, n_chars long, leaking long, quality_score double, copy_number int, "
    "mix_place string, mix_copy long, row_key string, Row_Key_ string, component_id long, item_id long, place long, score double"
)
OWN = (9, 0.5, 3, "p", 4, "k", "K", 5, 6, 7, 0.25)
ITEM = " ".join(f"question{i}" for i in range(25))
PLAIN = " ".join(f"plain{i}" for i in range(40))
OTHER = " ".join(f"other{i}" for i in range(40))


def words(stem, n=40):
    return " ".join(f"{stem}{i}" for i in range(n))


def frame(spark, rows):
    data = [(i, t, s, len(t) if t is not None else None, *OWN) for i, t, s in rows]
    return spark.createDataFrame(data, CLASHING)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(1, 1), (None, 0), (2, None)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def pairs(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def untouched(df):
    return all(tuple(r)[4:] == OWN for r in df.collect())


def test_free_names(spark):
    df = spark.createDataFrame([], "a long, A_ long, b long")
    assert common.free_name(df, "a") == "a__" and common.free_name(df, "c") == "c"


def test_groups_are_told_apart_by_row(spark, folder):
    near = PLAIN.replace("plain39", "end")
    rows = [
        (1, PLAIN, "a"), (2, near, "a"), (2, OTHER, "a"),  # a near copy of 1 goes, the other text of its id stays
        (3, words("x"), "b"), (3, words("x") + " y", "b"),  # near copies under one id: one stays
        (None, words("n"), None), (None, words("n") + " m", None), (7, words("n"), None), (None, words("solo"), "b"),
        (4, "", "a"), (4, "", "b"), (5, None, "a"), (6, None, "a"),
    ]
    docs = frame(spark, rows)
    kept = pipeline.keep_one_of_each_group(spark, docs, folder)
    assert kept.columns == docs.columns and untouched(kept)
    got = pairs(kept)
    assert got[(1, PLAIN)] == 1 and got[(2, near)] == 0 and got[(2, OTHER)] == 1
    assert got[(3, words("x"))] + got[(3, words("x") + " y")] == 1
    # Null ids come first, so one of them stands for its group.
    assert got[(None, words("n"))] + got[(None, words("n") + " m")] == 1 and got[(7, words("n"))] == 0
    assert got[(None, words("solo"))] == 1
    assert got[(4, "")] == 1 and got[(5, None)] == 1 and got[(6, None)] == 1
    assert sum(got.values()) == 8


def test_only_texts_that_go_or_have_copies_are_shuffled(spark, folder):
    rows = [(k, words(f"t{k}_"), "a") for k in range(40)] + [(50, words("t3_"), "b"), (4, words("t4_"), "b"), (4, words("t4_"), "a")]
    docs = frame(spark, rows)
    kept = pipeline.keep_one_of_each_group(spark, docs, folder)
    assert pairs(kept) == Counter((k, words(f"t{k}_")) for k in range(40))
    plan = kept._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    stay, judged = (plan.children().apply(i).toString() for i in range(2))
    assert "Join" not in stay and "Window" not in stay and "Join" in judged and "Window" in judged
    # The texts that are joined have passed the filter.
    assert judged.index("Join") < judged.index("pythonUDF")


def test_leaks_are_told_apart_by_row(spark, folder):
    leak = f"{PLAIN} {ITEM} {OTHER}"
    rows = [(1, leak, "a"), (1, PLAIN, "a"), (None, leak, "a"), (None, OTHER, "a"), (2, None, "a"), (3, "", None),
            (4, leak, None), (4, leak, None), (5, PLAIN, "a"), (5, PLAIN, "a")]
    docs = frame(spark, rows)
    kept = pipeline.drop_leaks(spark, docs, folder)
    assert kept.columns == docs.columns and untouched(kept)
    assert pairs(kept) == Counter([(i, t) for i, t, _ in rows if t != leak])
    assert pairs(decontaminate.clean_documents(docs, spark.createDataFrame([], "item_id long, text string"))) == pairs(docs)


def test_stages_leave_other_columns_alone(spark, folder):
    rows = [(i, words(f"s{i}_", 50), f"s{i % 3}") for i in range(9)] + [(20, None, None), (21, "", "s0"), (None, OTHER, None)]
    docs = frame(spark, rows)
    scored = pipeline.keep_quality(spark, docs, folder)
    assert scored.columns == docs.columns and untouched(scored)
    mixed = pipeline.mix(spark, docs, folder)
    assert mixed.columns == docs.columns and untouched(mixed)
    tokens = pipeline.write_tokens(spark, docs, folder).collect()
    assert Counter(r["doc_id"] for r in tokens) == Counter(i for i, _, _ in rows)
    again = pipeline.mix(spark, docs.repartition(5), folder)
    assert pairs(mixed) == pairs(again)


def test_stages_of_nothing(spark, folder):
    for _, stage in pipeline.STAGES:
        assert stage(spark, frame(spark, []), folder).count() == 0


def test_small_sources_meet_their_targets(spark):
    rows = [(8 * s + d, words(f"w{s}{d}_", 10), f"s{s}") for s in range(8) for d in range(5)]
    docs = frame(spark, rows)
    plan = mixing.plan_mix(docs).collect()
    taken, target = Counter(), {}
    for r in plan:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    # Sainte-Lague itself, one word at a time.
    seats = dict.fromkeys(target, 0)
    for _ in range(400):
        s = max(sorted(seats), key=lambda s: target[s] / (2 * seats[s] + 1))
        seats[s] += 1
    assert all(abs(taken[s] - target[s]) < 1 and abs(taken[s] - seats[s]) <= 1 for s in target)
    assert sum(taken.values()) == 400
