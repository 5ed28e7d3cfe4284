from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer

from walletlens import schemas
from walletlens.operators import features


def test_correlation(spark):
    random.seed(6)
    data = [(random.randint(1, 50), random.randint(1, 50)) for _ in range(200)]
    df = spark.createDataFrame(data, "x int, y int")
    got = {(r.col_x, r.col_y): r.correlation for r in features.correlation_matrix(df, ["x", "y"]).collect()}
    assert got["x", "y"] == pytest.approx(np.corrcoef(*zip(*data))[0, 1])
    assert got["x", "y"] == pytest.approx(got["y", "x"]) and got["x", "x"] == pytest.approx(1.0)


def test_minmax(spark):
    ranks = spark.createDataFrame([(1, 0.15), (2, 1.15), (3, 0.65)], schemas.RANKS)
    assert dict(rows(features.pagerank_scores(ranks))) == pytest.approx({1: 0.0, 2: 1.0, 3: 0.5})
    flat = spark.createDataFrame([(1, 0.15), (2, 0.15)], schemas.RANKS)
    assert rows(features.pagerank_scores(flat)) == [(1, 0.0), (2, 0.0)]


def test_scores_and_confidence(spark):
    pairs = spark.createDataFrame(
        [(1, 1, 10, 5), (1, 2, 10, 6), (9, 1, 3, 5)], schemas.INDEXED_PAIRS
    )
    scores = spark.createDataFrame([(1, 0.5), (2, 1.0)], "user_id bigint, pagerank_score double")
    scored = features.attach_scores(pairs, scores)
    assert rows(scored, "user_id", "pagerank_score") == [(1, 0.5), (1, 0.5), (9, 0.0)]
    assert rows(features.score_coverage(scored)) == [(2, 1, 50.0)]
    assert rows(features.score_coverage(scored.limit(0))) == [(0, 0, 0.0)]
    rated = {r.user_id: r.ultimate_confidence for r in features.ultimate_confidence(scored).collect()}
    assert rated == pytest.approx({1: math.log(11) * 1.5, 9: math.log(4)})


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (6.0,)], "v double")
    got = features.describe_column(df, "v").first()
    assert tuple(got) == pytest.approx((3, 3.0, np.std([1, 2, 6], ddof=1), 1.0, 6.0))


def test_frequency_index_equals_the_library_indexer(spark):
    random.seed(7)
    # One user holds a third of the rows, many tie.
    data = [(1, i) for i in range(100)] + [(random.randrange(300), random.randrange(40)) for _ in range(200)]
    df = spark.createDataFrame(data + [(None, 3)], "user_id bigint, token_id bigint")
    stages = [
        StringIndexer(inputCol=c, outputCol=f"{c}_int", handleInvalid="keep")
        for c in ("user_id", "token_id")
    ]
    want = Pipeline(stages=stages).fit(df).transform(df)
    got = features.frequency_index(df, {"user_id": "user_id_int", "token_id": "token_id_int"})
    names = ["user_id", "token_id", "user_id_int", "token_id_int"]
    assert rows(got, *names) == rows(
        want.withColumn("user_id_int", want.user_id_int.cast("int")).withColumn(
            "token_id_int", want.token_id_int.cast("int")
        ),
        *names,
    )


def test_split_is_stable(spark):
    df = spark.range(20000).selectExpr("id as u", "id % 7 as i")
    train, test = features.train_test_split(df, ["u", "i"])
    assert train.count() + test.count() == 20000
    assert train.count() == pytest.approx(16000, rel=0.03)
    again, _ = features.train_test_split(df.repartition(13), ["u", "i"])
    assert train.exceptAll(again).count() == 0
    other, _ = features.train_test_split(df, ["u", "i"], seed=1)
    assert other.exceptAll(train).count() > 0
