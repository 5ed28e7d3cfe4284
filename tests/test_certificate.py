"""The optimality check of fitted factors: real fits pass, anything else does not."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from walletlens.operators import certificate, recommend

REG, ALPHA, RANK = 0.1, 15.0, 4


@pytest.fixture(scope="module")
def train(spark):
    draw = random.Random(5)
    pairs = {(u, i): draw.choice([0.5, 1.0, 3.0, 0.0, -1.0]) for u in range(1, 40) for i in draw.sample(range(25), 6)}
    pairs |= {(0, i): 1.0 for i in range(25)}  # one user holds everything
    pairs |= {(50, i): -1.0 for i in range(3)} | {(51, 4): 0.0}  # these like nothing
    rows = [(u, i, r) for (u, i), r in pairs.items()]
    return spark.createDataFrame(rows, "user_id_int int, token_id_int int, ultimate_confidence double")


@pytest.fixture(scope="module")
def model(train):
    return recommend.train_als(train, RANK, REG, ALPHA, max_iter=5)


def by_hand(model, rows):
    """The same violations from whole matrices, id by id."""
    items = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    every = np.array(list(items.values()))
    out = {}
    for r in model.userFactors.collect():
        x = np.array(r["features"], float)
        matrix, target, n = every.T @ every, np.zeros(RANK), 0
        for user, item, rating in rows:
            if user == r["id"]:
                y = items[item]
                matrix = matrix + ALPHA * abs(rating) * np.outer(y, y)
                if rating > 0:
                    target, n = target + (1 + ALPHA * abs(rating)) * y, n + 1
        g = (matrix + REG * n * np.eye(RANK)) @ x - target
        breach = np.where(x > 0, abs(g), np.maximum(-g, 0)).max()
        out[r["id"]] = breach / abs(target).max() if n else breach
    return out


def test_fit_is_certified(model, train):
    checked = {r["id"]: r for r in recommend.certify_model(model, train, REG, ALPHA).collect()}
    want = by_hand(model, [tuple(r) for r in train.collect()])
    assert checked.keys() == want.keys() and 0 in want and 50 in want
    for i, r in checked.items():
        assert r["is_feasible"] and r["is_optimal"]
        assert abs(r["violation"] - want[i]) < 1e-9
    assert checked[0]["n_pairs"] == 25


def share_optimal(solved, model, train, reg=REG, alpha=ALPHA):
    ratings = train.select(F.col("user_id_int").alias("id"), F.col("token_id_int").alias("other"),
                           F.col("ultimate_confidence").alias("rating"))
    rows = certificate.optimality(solved, model.itemFactors, ratings, reg, alpha).collect()
    return sum(r["is_optimal"] for r in rows if r["id"] < 50) / 40


def test_other_factors_fail(spark, model, train):
    users = model.userFactors
    rows = sorted(users.collect())
    shifted = [(a["id"], b["features"]) for a, b in zip(rows, rows[1:] + rows[:1])]
    assert share_optimal(spark.createDataFrame(shifted, users.schema), model, train) < 0.1
    scaled = users.withColumn("features", F.transform("features", lambda x: x * 1.001))
    assert share_optimal(scaled, model, train) < 0.1
    assert share_optimal(users, model, train, alpha=16.0) < 0.1
    assert share_optimal(users, model, train, reg=0.12) < 0.1
    assert share_optimal(users, model, train) == 1


def test_missing_and_negative_factors(spark, model, train):
    some = model.userFactors.where("id <> 0").withColumn(
        "features", F.when(F.col("id") == 1, F.transform("features", lambda x: -x)).otherwise(F.col("features"))
    )
    ratings = train.select(F.col("user_id_int").alias("id"), F.col("token_id_int").alias("other"),
                           F.col("ultimate_confidence").alias("rating"))
    rows = {r["id"]: r for r in certificate.optimality(some, model.itemFactors, ratings, REG, ALPHA).collect()}
    assert not rows[0]["is_feasible"] and not rows[0]["is_optimal"] and rows[0]["n_pairs"] == 0
    assert not rows[1]["is_feasible"] and rows[2]["is_optimal"]


def test_gram_matrix(spark):
    y = np.random.default_rng(1).random((50, 3)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "id int, features array<float>")
    assert np.allclose(certificate.gram_matrix(table.repartition(5)), y.astype(float).T @ y)


def test_lists_of_a_model_equal_a_scan(model, train):
    items = {r["id"]: np.array(r["features"], float) for r in model.itemFactors.collect()}
    held = {tuple(r) for r in train.select("user_id_int", "token_id_int").collect()}
    for seen in (None, train):
        got = {}
        for r in recommend.recommend_top_n(model, train, 7, exclude_seen=seen).orderBy("rank").collect():
            got.setdefault(r["user_id_int"], []).append(r["token_id_int"])
        for r in model.userFactors.collect():
            x = np.array(r["features"], float)
            kept = [i for i in items if seen is None or (r["id"], i) not in held]
            assert got.get(r["id"], []) == sorted(kept, key=lambda i: (-(items[i] @ x), i))[:7]
