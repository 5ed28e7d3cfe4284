"""Registered queries of the subpackage over whole sample tables: against SQL, or against brute force."""

from __future__ import annotations

import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from check_oracle import compare, connect  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from walletlens.llm import decontaminate, queries, sql  # noqa: E402
from walletlens.llm.common import table  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are absent")


@pytest.fixture(scope="module")
def texts(spark):
    rows = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def test_all_are_registered():
    found = [n for n in entry_points.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in found) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", sorted(sql.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    verdict = compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), sql.ORACLE_SQL[name])
    assert verdict.startswith("ok"), verdict


def test_classifier_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    rows = queries.op2_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    judged = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 50 and sum(judged) / len(judged) >= 0.95


def test_chat_format_runs_no_python(spark):
    plan = queries.op3_chat_format(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_leaks_are_all_exact_copies_and_more(spark, texts):
    found = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontaminate(spark, FOLDER).collect()}
    items = {r["item_id"]: decontaminate.plain_words(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()}
    plain = {k: b" ".join(decontaminate.plain_words(t)) for k, t in texts.items()}
    copies = {(k, i) for k, t in plain.items() for i, w in items.items() if b" ".join(w) in t}
    assert copies and copies <= found
    for doc, item in found - copies:  # whatever else is reported holds most of the item in order
        share = decontaminate.common_subsequence(items[item], decontaminate.plain_words(texts[doc])) / len(items[item])
        assert share >= decontaminate.LEAST_COMMON


def test_suffix_dedup_equals_brute_force(spark, texts):
    coded = {k: t.encode() for k, t in texts.items()}
    seen = Counter(b[i : i + 400] for b in coded.values() for i in range(len(b) - 399))
    rows = {r["doc_id"]: r for r in queries.op6_suffix_dedup(spark, FOLDER).collect()}
    assert rows.keys() == coded.keys()
    for k, b in coded.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) > 0).sum())
        want = (k, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
        assert tuple(rows[k]) == want


def test_pages_equal_their_articles(spark):
    import html

    pages = {r["page_id"]: r["html"] for r in table(spark, FOLDER, "pages").collect()}
    for r in queries.op8_html_extract(spark, FOLDER).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inside)).split())
        assert r["n_chars"] == len(r["text"])


def test_tokens_equal_the_library(spark, texts):
    whole = Tokenizer.from_file(queries.TOKENIZER)
    rows = {r["doc_id"]: r for r in queries.op9_token_output(spark, FOLDER).collect()}
    assert rows.keys() == texts.keys()
    at = 0
    for k in sorted(texts):
        ids = np.array(whole.encode(texts[k], add_special_tokens=False).ids + [1], "<u4")
        assert tuple(rows[k]) == (k, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_secrets_equal_plain_expressions(spark, texts):
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for r in queries.op10_secret_scan(spark, FOLDER).collect():
        text = texts[r["doc_id"]]
        base = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        base += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        base += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        shown = [f"{k}:{a}:{b}" for a, _, k, b in sorted(base)]
        assert r["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest()
        assert set(shown) <= set(r["spans"].split(","))
        counts = Counter(k for _, _, k, _ in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (counts["assign"], counts["access"], counts["hex"])


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as pipeline

    docs = table(spark, FOLDER, "documents")
    columns, kept, stored = docs.columns, [], docs
    for _, stage in pipeline.STAGES[:4]:
        stored = pipeline.written(stage(spark, stored, FOLDER))
        assert stored.columns == columns
        kept.append(stored.collect())
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    good = sum(labels.values())
    assert sum(labels.get(r["doc_id"], 0) for r in kept[0]) >= 0.9 * good
    # One document of each group of the first stage's output, by brute force.
    sets = {r["doc_id"]: _shingles(r["text"] or "") for r in kept[0]}
    groups = _groups(sets)
    assert sorted(r["doc_id"] for r in kept[1]) == sorted({groups[k] for k in sets})
    leaks = {r["doc_id"] for r in decontaminate.find_leaks(spark.createDataFrame(kept[1], docs.schema),
                                                         table(spark, FOLDER, "benchmark")).collect()}
    assert sorted(r["doc_id"] for r in kept[2]) == sorted(r["doc_id"] for r in kept[1] if r["doc_id"] not in leaks)
    sizes = lambda rows: sum(len((r["text"] or "").encode().split()) for r in rows)
    assert abs(sizes(kept[3]) / sizes(kept[2]) - 1) < 0.02
    out = pipeline.run(spark, FOLDER).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in kept[3])
    ordered = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted(r["doc_id"] for r in out)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))


def _shingles(text: str) -> frozenset:
    words = [w.lower() for w in text.encode().split()]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _groups(sets: dict) -> dict:
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for k in sorted(sets):
        common = Counter(o for s in sets[k] for o in holders[s])
        for s in sets[k]:
            holders[s].append(k)
        for o, n in common.items():
            if 100 * n >= 80 * (len(sets[k]) + len(sets[o]) - n):
                a, b = find(k), find(o)
                up[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}
