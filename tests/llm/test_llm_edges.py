"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from walletlens.llm import (
    chat_format,
    components,
    decontaminate,
    html_extract,
    jaccard_join,
    mixing,
    quality_classifier,
    quality_rules,
    queries,
    secret_scan,
    suffix_dedup,
    token_output,
)

LONG = " ".join(f"w{i * 7919 % 100003}" for i in range(60_000))
SHARED = " ".join(f"shared{i}" for i in range(90))
ROWS = [
    (1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "one two"), (4, "one two"), (5, LONG), (6, LONG + " end"),
    (7, SHARED + " left over"), (8, "before " + SHARED), (None, "no id here"), (9, "é ü 😀 \x00 zero"),
    (10, "x" * 3000), (11, "one TWO"),
]
CLASHING = "doc_id long, text string, source string, score double, kept boolean, size long, tie long, n string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i == 4 else f"s{(i or 0) % 3}", 0.0, True, 7, 8, "n") for i, t in ROWS]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], CLASHING)


def ids(df):
    return Counter(r["doc_id"] for r in df.collect())


ALL_IDS = Counter(i for i, _ in ROWS)


def test_rules(docs, nothing):
    rows = {r["doc_id"]: r for r in quality_rules.rule_report(docs).collect()}
    assert ids(quality_rules.rule_report(docs)) == ALL_IDS
    assert tuple(rows[1])[1:] == tuple(rows[2])[1:] == (0, 0, 0, 0, 0, True, False)
    assert rows[5]["n_words"] == 60_000 and rows[5]["n_repeat_words"] == 0 and rows[5]["kept"]
    assert quality_rules.rule_report(nothing).collect() == []
    assert quality_rules.apply_rules(docs).columns == docs.columns


def test_rule_order_follows_rejections_per_cost():
    rules = [quality_rules.Rule(n, lambda f: False) for n in "abc"]
    order = quality_rules.ordered(rules, [("a", 1.0, 0.1), ("b", 0.1, 0.1), ("c", 9.0, 0.9)])
    assert [r.name for r in order] == ["b", "a", "c"]


@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=60, deadline=None)
def test_repeated_words(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    assert quality_rules.TextFacts(" ".join(words)).n_repeat_words == len(covered)


def test_classifier(spark, docs, nothing):
    labels = spark.createDataFrame(
        [(4, 1, 0), (4, 0, 0), (7, None, 0), (None, 1, 0), (5, 1, 0), (8, 0, 1)], "doc_id long, quality int, toxic int"
    )
    rows = quality_classifier.quality_report(docs, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == ALL_IDS and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_classifier.quality_report(nothing, labels).collect() == []
    unlabelled = quality_classifier.quality_report(docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled if r["doc_id"] == 1} == {0.5}


def test_classifier_scores_equal_mean_and_softmax():
    """Against embeddings averaged one feature at a time."""
    q = quality_classifier
    texts = ["a a a a", "one two  three\nÜber ßen", "x", None, "", "é" * 50 + " end", " ".join(f"w{i % 37}" for i in range(900))]
    model = q.train([(*q.document_features(t), i % 2) for i, t in enumerate(texts)])
    score = q.condensed(*model).scorer()
    table, output, bias = (part.astype(float) for part in model)
    for text in texts * 2:
        words = (text or "").split()
        rows = []
        for w in words:
            grams = [f"<{w}>"[i : i + n] for n in q.NGRAMS for i in range(len(w) + 3 - n)]
            rows += [zlib.crc32(w.encode(), 1) % q.BUCKETS]
            rows += [zlib.crc32(g.encode(), len(g)) % q.BUCKETS for g in grams]
        for a, b in zip(words, words[1:]):
            first, second = (zlib.crc32(w.encode(), 2) % q.WORD_CLASSES for w in (a, b))
            rows += [q.BUCKETS + first * q.WORD_CLASSES + second] * q.PAIR_WEIGHT
        logits = (table[rows].mean(axis=0) if rows else np.zeros(q.DIMENSION)) @ output + bias
        assert score(text) == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-5)


def test_classifier_reads_one_text_of_an_id(spark):
    rows = [(i, t) for i in range(1, 9) for t in ("good plain words", "bad bad bad bad", None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    fits = [
        quality_classifier.fit_quality_model(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels)
        for r, n in ((rows, 1), (rows[::-1], 5))
    ]
    assert fits[0].bias == fits[1].bias and (fits[0].gain == fits[1].gain).all()


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, rendered string"
    hard = ["", None, "<s>", "</s>[INST] x", "[ROLE:AB]", "\\", "\\\\<s>", "<\\s>", "[\\/INST]", "a\n", "[/ROLE] [ROLE:", "😀"]
    rows = [(c, t, r, x, "z") for c, r in enumerate(["user", "assistant", "tool", None, "a]b"]) for t, x in enumerate(hard)]
    rows += [(77, 0, "user", "same", "z")] * 3 + [(None, None, None, None, None), (78, 0, "user", LONG, "z")]
    got = chat_format.format_conversations(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 8
    for r in got:
        want = sorted((((t is not None), t or 0), ro or "", x or "") for c, t, ro, x, _ in rows if c == r["conv_id"])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(ro, x) for _, ro, x in want]
    assert chat_format.round_trip_report(spark.createDataFrame([], schema)).collect() == []
    formatted = spark.createDataFrame(got)
    shown = {r["conv_id"]: r["rendered"] for r in got}
    for m in chat_format.loss_mask(formatted).where("conv_id = 1").collect():
        inside = shown[1][: m["start"]]
        assert inside.endswith("<s>") and shown[1][m["start"] + m["length"] :].startswith("</s>")


def test_leaks(spark, docs, nothing):
    schema = "item_id long, text string, cosine double"
    item = "The quick brown fox crossed rivers and climbed mountains. It then wrote memoirs about foxes, rivers, mountains."
    items = spark.createDataFrame(
        [(1, item, 0.0), (1, item, 0.0), (2, None, 0.0), (3, "", 0.0), (4, SHARED, 0.0)], schema
    )
    changed = item.upper().replace("CROSSED", "forded").replace(".", " --")
    scrambled = " ".join(random.Random(3).sample(item.split(), len(item.split())))
    filler = " ".join(f"filler{i}" for i in range(500))
    more = spark.createDataFrame(
        [(20, f"{filler} {changed} {filler}"), (21, f"{filler} {scrambled}"), (22, filler), (None, item)],
        "doc_id long, text string",
    )
    found = decontaminate.find_leaks(docs.select("doc_id", "text").union(more), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(20, 1), (None, 1), (7, 4), (8, 4)}
    assert decontaminate.find_leaks(nothing, items).collect() == []
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []
    assert ids(decontaminate.clean_documents(docs, items)) == ALL_IDS - Counter([7, 8])
    assert decontaminate.clean_documents(docs, items).columns == docs.columns


def test_leaks_without_the_last_sentence(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    head, tail = [word() for _ in range(36)], [word() for _ in range(9)]
    loose = head[:18] + [word() for _ in range(3)] + head[18:]
    items = [(1, f"{' '.join(head)}. Zanzibar."), (2, f"{' '.join(head[::-1])}. {' '.join(tail)}.")]
    filler = [(i, " ".join(word() for _ in range(200))) for i in range(100, 140)]
    docs = [
        (1, f"{' '.join(loose)}. Madagascar."),  # all but the last word
        (2, " ".join(head)),  # lacks the last sentence of one word
        (3, " ".join(head[::-1] + [word() for _ in range(9)])),  # the question with another answer
        (4, " ".join(head[::-1] + tail[:6])),  # most of the answer
    ]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs + filler, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 1), (4, 2)}


def test_leaks_beyond_the_rank_of_the_space(spark):
    rng = random.Random(5)
    vocabulary = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=300)) for _ in range(60)]
    items = {}
    for i in range(900):
        words = texts[i % 60].split()
        at, n = rng.randrange(250), rng.choice([3, 4, 5, 6, 7, 9, 12, 15, 20, 40])
        items[i] = " ".join(words[at : at + n])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontaminate.find_leaks(docs, spark.createDataFrame(list(items.items()), "item_id long, text string"))
    copies = {(d, i) for d, t in enumerate(texts) for i, x in items.items() if f" {x} " in f" {t} "}
    assert len(copies) >= 900 and copies <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12), st.lists(st.sampled_from([b"a", b"b", b"d"]), max_size=12))
@settings(max_examples=80, deadline=None)
def test_common_subsequence(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    assert decontaminate.common_subsequence(a, b) == best[-1][-1]


def test_mixing(spark, docs, nothing):
    plan = mixing.plan_mix(docs).collect()
    assert Counter(r["doc_id"] for r in plan) == ALL_IDS
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in plan)
    assert {r["size"] for r in plan if r["doc_id"] in (1, 2, 3)} == {0}
    assert sorted(map(tuple, mixing.plan_mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, plan), key=str)
    assert mixing.plan_mix(nothing).collect() == []
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len((r["text"] or "").encode().split())
    taken = Counter()
    for r in plan:
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken


def test_targets_are_capped_and_reshared(spark):
    sources = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 5)], "source string, source_size long")
    rows = {r["source"]: r["target"] for r in mixing.source_targets(sources).collect()}
    assert rows["b"] == 30 and rows["a"] == 300 and rows[None] == 15
    assert rows["c"] == pytest.approx(1115 - 345)


def test_apportionment_is_sainte_lague(spark):
    shares = [53.0, 24.0, 23.0, 0.2, 7.8]
    parties = spark.createDataFrame([(0, i, s, 108, 60) for i, s in enumerate(shares)],
                                    "g int, i int, share double, seats long, most long")
    got = {r["i"]: r["quota"] for r in mixing.apportion(parties, ["g"], "share", "seats", "most", ["i"]).collect()}
    want = dict.fromkeys(got, 0)
    for _ in range(108):
        i = max(want, key=lambda i: (shares[i] / (2 * want[i] + 1), -i))
        want[i] += 1
    assert got == want


@pytest.mark.parametrize("chunk", [2, suffix_dedup.CHUNK])
def test_suffix_dedup(spark, docs, nothing, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    random_words = random.Random(5)
    core = "".join(random_words.choice("abcdefgh ") for _ in range(700))
    extra = [(100 + i, f"{random_words.random()} {core[i * 9 :]} {random_words.random()}") for i in range(12)]
    extra += [(150, "ab" * 900), (151, core[:399]), (152, core[:400])]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    coded = [(i, (t or "").encode()) for i, t in ROWS + extra]
    seen = Counter(b[i : i + 400] for _, b in coded for i in range(len(b) - 399))
    want = Counter()
    for k, b in coded:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        want[k, len(b), int(gone.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()] += 1
    rows = suffix_dedup.remove_repeats(both).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in rows) == want
    assert suffix_dedup.remove_repeats(nothing).collect() == []


@given(st.integers(1, 4), st.integers(0, 10**6))
@settings(max_examples=15, deadline=None)
def test_string_classes(letters, seed):
    rng = np.random.default_rng(seed)
    base = bytes(rng.integers(97, 97 + letters, 1500).astype(np.uint8))
    segments = [base[i : i + 400 + int(rng.integers(0, 200))] for i in rng.integers(0, 900, 8)]
    segments += [b"zz" + b"a" * 420, bytes(range(255, -1, -1)) + b"q" * 200, b"b" * 300 + b"a" * 250]
    names: dict[bytes, set] = {}
    for segment, classes in zip(segments, suffix_dedup.string_classes(segments)):
        for i, c in enumerate(classes.tolist()):
            names.setdefault(segment[i : i + 400], set()).add(c)
    assert all(len(v) == 1 for v in names.values())
    assert len({min(v) for v in names.values()}) == len(names)


@pytest.mark.parametrize("group", [4, jaccard_join.GROUP_SETS])
def test_near_duplicates(spark, docs, nothing, monkeypatch, group):
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", group)
    rng = random.Random(2)
    base = [f"word{i}" for i in range(300)]
    near = []
    for i in range(40):
        words = base.copy()
        for _ in range(rng.choice([2, 5, 8])):
            words[rng.randrange(300)] = f"new{rng.random()}"
        near.append((200 + i, " ".join(words)))
    extra = [*near, (300, " ".join(base)), (301, " ".join(base).upper()), (302, " ".join(base[:230]))]
    rows = jaccard_join.near_duplicates(
        docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    ).collect()
    from test_llm_queries import _groups, _shingles

    known = [(i, t or "") for i, t in ROWS + extra if i is not None]
    sets = {i: _shingles(t) for i, t in known}
    groups = _groups(sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert got == {i: (len(sets[i]), groups[i] if sets[i] else i) for i in sets}
    assert len(rows) == len(ROWS) + len(extra)
    assert jaccard_join.near_duplicates(nothing).collect() == []


def test_prefix_tree_finds_all_links():
    rng = np.random.default_rng(4)
    base = np.arange(60)
    sets = [np.unique(np.concatenate([rng.choice(base, 50, replace=False), rng.integers(60, 90, k % 9)])) for k in range(60)]
    tree = jaccard_join.PrefixTree(sets)
    for own in sets:
        contains = np.zeros(90, bool)
        contains[own] = True
        want = {i for i, s in enumerate(sets)
                if jaccard_join.linked(len(np.intersect1d(own, s)), len(own), len(s))}
        assert set(tree.walk(own, contains)) == want


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    up = list(range(1100))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in linked}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


PAGES = [
    ("", ""),
    ("<p>Short.</p>", "Short."),
    ("<nav>menu</nav><article><h1>T</h1><p>a <b>b</b>c &amp;amp; d&nbsp;e</p></article><footer>f</footer>", "T a bc &amp; d e"),
    ("<div class='cookie-notice'>We use cookies</div><main>Text<aside>side</aside> goes on</main>", "Text goes on"),
    ("<article>One<form><input>x</form><div class=\"comments\"><p>me too</p></div><p>Two</p></article>", "One Two"),
    ("<article>cut off by the end <b", "cut off by the end"),
    ("<div class=ad>open<article>kept</article>", "kept"),
    ("<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<body><div>" + "<p>" + "long text " * 20 + "</p></div><ul><li><a>x</a></li></ul></body>", ("long text " * 20).strip()),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_page(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>x</title><meta charset=utf-8><body><p>All of it.</p></body></html>", "All of it."),
    ("<head><title>x<body><p>All of it.</p>", "All of it."),
    ("<head><link rel=a><script>1</script><p>All of it.</p>", "All of it."),
    ("<p>Before <svg class='i' /> and <math/> after.</p><p>More.</p>", "Before and after. More."),
    ("<p>A <svg><title>t</title><path d='M0'/><text>no</text></svg>b.</p>", "A b."),
    ("<p>A</p><iframe src='x'><p>All of it.</p>", "A All of it."),
    ("<p>A</p><script>if (a) { '<p>no</p>'", "A"),
])
def test_heads_and_raw_elements_take_no_text_with_them(page, text):
    assert html_extract.main_text(page) == text


BODY = ("long text " * 20).strip()


@pytest.mark.parametrize("page,text", [
    (f"<div class='post has-sidebar'><p>{BODY}</p></div>", BODY),
    (f"<div class='layout no-sidebar'><p>{BODY}</p><div class='cookie-banner'>no</div></div>", BODY),
    (f"<div class='overflow-hidden' data-id='menu' aria-hidden='false'><p>{BODY}</p></div>", BODY),
    ("<article><h2 id='related-work'>A</h2><section id='menu'>B</section><p id='notice'>C</p></article>", "A B C"),
    (f"<p class='ad'>no<p>{BODY}", BODY),
    (f"<ul><li class=ad>no</ul><p>{BODY}</p>", BODY),
    (f"<div><p class='ad'>no</div>{BODY}", BODY),
    (f"<div><div class='ad'>no<p>no</p></section></div></div><p>{BODY}</p>", BODY),
    (f"<div><section class='ad'>no<div>no</div></div><p>{BODY}</p>", BODY),
    (f"<div><a name='x'><p>{BODY}</p><p>{BODY}</p></div>", f"{BODY} {BODY}"),
    (f"<div><span class='ad'>no<p>{BODY}</p></div>", BODY),
    (f"<p>{BODY}</p><ul><li><a href=/a/>no</a><li><a href=b><div>no</div></a></ul>", BODY),
])
def test_names_and_omitted_end_tags_take_no_text_with_them(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<div><p>{BODY}</p><p>{BODY}</p></div><article>Teaser</article>", f"{BODY} {BODY}"),
    (f"<div><p>{BODY}</p></div><aside><article>{BODY} teaser</article></aside>", BODY),
    (f"<div><p>{BODY}</p></div><div class=comments><article><p>{BODY} me too</p></article></div>", BODY),
    (f"<article><h1>T</h1><p>{BODY}</p><div class='ad'>no</div><p>End</p></article><div>Imprint</div>", f"T {BODY} End"),
    (f"<form><p>no</p><main><p>{BODY}</p><form>no</form></main><p>no</p></form><p>no</p>", BODY),
    (f"<main><h1>T</h1><article>{BODY}</article><p>End</p></main>", f"T {BODY} End"),
])
def test_lines_outside_articles_count(page, text):
    assert html_extract.main_text(page) == text


LINES = [f"Paragraph {i} tells of rivers, mountains and the long road that runs between them and the sea." for i in range(5)]
DIVS, PLAIN = "".join(f"<div>{line}</div>" for line in LINES), " ".join(LINES)


@pytest.mark.parametrize("page,text", [
    (f"<div>Home</div><div>About us</div>{DIVS}<div>Copyright 2024</div>", PLAIN),
    (f"<table><tr><td>Home</td><td>News</td><td>Contact</td></tr></table>{DIVS}", PLAIN),
    (f"<div>Home</div><div>Shop</div><h1>Rivers</h1><h2>A<br>walk</h2>{DIVS}<h3>More</h3>", f"Rivers A walk {PLAIN}"),
    (f"{DIVS}<p>Yes.</p><p>No</p>{DIVS}<p>The end.</p>", f"{PLAIN} Yes. No {PLAIN} The end."),
    (f"<article>{DIVS}</article><div class='replies'><p>{LINES[0]}</p></div>", PLAIN),
    (f"<div>{DIVS}</div><div class='discussion'><p>{LINES[0]}</p><p>{LINES[1]}</p></div>", PLAIN),
    (f"<article>{DIVS}<div class='discussion'>{LINES[0]}</div>End</article>", f"{PLAIN} {LINES[0]} End"),
    (f"<div>{DIVS}</div><section class='discussion'>{LINES[0]}</section>", f"{PLAIN} {LINES[0]}"),
    ("<div>Roses are red</div><div>violets are blue</div>" * 9, " ".join(["Roses are red violets are blue"] * 9)),
])
def test_distribution_finds_text_without_tags_that_name_it(page, text):
    assert html_extract.main_text(page) == text


def test_pages_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (1, "u", None, "x", "y"), (2, None, "<p>" + LONG, "x", "y")]
    got = html_extract.extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, 0), (1, 0), (2, len(LONG))]
    assert html_extract.extract_pages(spark.createDataFrame([], schema)).collect() == []


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
@settings(max_examples=100, deadline=None)
def test_variable_length_codes(ids):
    array = np.array(ids, np.uint32)
    assert token_output.decode_ids(*token_output.encode_ids(array), len(ids)).tolist() == ids
    got, sizes = token_output.unpack_block(token_output.pack_block(array, np.array([len(ids)])))
    assert got.tolist() == ids and sizes.tolist() == [len(ids)]


def test_other_bytes_are_no_block():
    with pytest.raises(ValueError):
        token_output.unpack_block(b"PAR1" * 20)


def test_tokens(spark, docs, nothing):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(queries.TOKENIZER)
    rows = token_output.token_report(docs, queries.TOKENIZER).collect()
    want = Counter()
    for i, t in ROWS:
        ids = np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, *sorted(i for i, _ in ROWS if i is not None)]
    assert rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    assert token_output.token_report(nothing, queries.TOKENIZER).collect() == []


@given(st.text(alphabet=st.sampled_from("aZé'’.,!<|>endoftext 12İΣßﬁ😀\x00\x85\x1c_"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_words_give_the_text_tokens(text):
    tokenizer = token_output.worker_tokenizer(queries.TOKENIZER)
    want = tokenizer.whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == want


def test_secrets(spark, docs, nothing):
    key = "-----BEGIN RSA PRIVATE KEY-----"
    rows = [(1, "é password: 'abcDEF123456' x"), (2, f"AKIA{'A' * 14} {'0f' * 8} {key}"), (3, "token=short"), (4, None),
            (4, None), (5, "ghp_" + "a1B2" * 9), (6, LONG + " secret = " + "k" * 5000)]
    got = secret_scan.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert len(got) == len(rows)
    assert spans[1] == "assign:2:25" and spans[3] == spans[4] == ""
    assert spans[2] == f"access:0:18,hex:19:35,private_key:36:{36 + len(key)}"
    assert spans[5] == "github:0:40" and spans[6].startswith("assign:")
    assert ids(secret_scan.secret_report(docs)) == ALL_IDS
    assert secret_scan.secret_report(nothing).collect() == []


@given(st.text(alphabet=st.sampled_from("AKIa0f9tokens:= '\n"), max_size=80))
@settings(max_examples=150, deadline=None)
def test_automaton_finds_what_expressions_find(text):
    import re

    want = []
    for k, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.find, text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                want.append((m.start(), m.end(), k))
    assert secret_scan.scan_texts([text])[0] == [(secret_scan.RULES[k].kind, a, b) for a, b, k in sorted(want)]


@given(st.text(alphabet=st.sampled_from("AKIa0f9tokens:= '\n"), max_size=200), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_lanes_begun_wrongly_are_run_again(text, lane_bytes):
    machine = secret_scan.compile_rules(tuple(r.detect for r in secret_scan.RULES))
    data = np.frombuffer(text.encode(), np.uint8)
    whole, cut = (secret_scan.scan_bytes(machine, data, n) for n in (1 << 20, lane_bytes))
    assert [x.tolist() for x in whole] == [x.tolist() for x in cut]


@pytest.mark.parametrize("line", ["0f" * 150_000, "plain prose without commas " * 10_000, "token=" + "aB3+" * 70_000, "AKIA" * 70_000])
def test_secrets_in_one_long_line(line):
    import re

    text = line + " token = abcDEF123456 " + line
    want = []
    for k, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.find, text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                want.append((m.start(), m.end(), k))
    assert want
    assert secret_scan.scan_texts([text])[0] == [(secret_scan.RULES[k].kind, a, b) for a, b, k in sorted(want)]
