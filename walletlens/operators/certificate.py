"""Whether the factors of a fitted model are what the fit should have found.

The non-negative implicit fit solves, for each id of the side it solves last, a quadratic problem in that id's factors x:
the other side's factors y give the matrix Y'Y plus alpha r y y' for each rated pair, and lambda times the number of
positive ratings on the diagonal.  x is the minimum exactly if it is feasible (x >= 0), the gradient is nowhere
negative, and is zero wherever x is positive.  The gradient is a sum over pairs, so no matrix per id is ever made:

    g = Y'Y x + sum over pairs of (alpha |r| (y . x) - [r > 0] (1 + alpha |r|)) y + lambda n x
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walletlens.functions.blocks import map_columns, matrix_of
from walletlens.functions.shared_storage import written

# Factors are stored as single floats, which leaves violations of some 1e-8; the solver stops at steps of 1e-7.
TOLERANCE = 1e-5
_PAIRS_AT_ONCE = 4096


def gram_matrix(factors: DataFrame) -> np.ndarray:
    """Y'Y of a factor table (id, features): each task adds up its outer products. At most rank squared numbers return."""

    def add(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = matrix_of(batch.column("features"), len(batch.column("features")[0]))
                total = y.T @ y + (0.0 if total is None else total)
        if total is not None:
            yield {"cell": np.arange(total.size), "value": total.ravel()}

    cells = map_columns(factors.select("features"), add, "cell int, value double")
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).orderBy("cell").collect()
    rank = round(len(found) ** 0.5)
    return np.array([r["value"] for r in found], np.float64).reshape(rank, rank)


def _pair_sums(pairs: DataFrame, rank: int, alpha: float) -> DataFrame:
    """Per id of a run of pairs: the pairs' part of the gradient and of its constant, and counts. Not yet one row per id."""

    def add(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _PAIRS_AT_ONCE):
                batch = whole.slice(at, _PAIRS_AT_ONCE)
                names, line = np.unique(batch.column("id").to_numpy(), return_inverse=True)
                rating = batch.column("rating").to_numpy().astype(np.float64)
                x, y = matrix_of(batch.column("x"), rank), matrix_of(batch.column("y"), rank)
                extra = alpha * np.abs(rating)
                wanted = np.where(rating > 0, 1 + extra, 0.0)
                product = np.einsum("ij,ij->i", x, y)
                pull, target = np.zeros((len(names), rank)), np.zeros((len(names), rank))
                np.add.at(pull, line, (extra * product)[:, None] * y)
                np.add.at(target, line, wanted[:, None] * y)
                yield {
                    "id": names, "pull": list(pull), "target": list(target),
                    "n_pairs": np.bincount(line), "n_positive": np.bincount(line, weights=rating > 0).astype(int),
                }

    return map_columns(
        pairs, add, "id int, pull array<double>, target array<double>, n_pairs long, n_positive long"
    )


def optimality(
    solved: DataFrame,
    fixed: DataFrame,
    ratings: DataFrame,
    reg: float,
    alpha: float,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per rated id of ``solved``: id, n_pairs, violation, is_feasible, is_optimal.

    ``solved`` and ``fixed`` are factor tables (id, features), ``ratings`` is (id, other, rating) with ``other`` an id of
    ``fixed``; pairs are unique, as the fit counts each row. ``violation`` is the largest breach of a condition above,
    relative to the id's largest target. A rated id without factors is infeasible.

    Sums are made where pairs lie before they are shuffled by id, so an id with most of the pairs sends one row
    for some thousand of them; the factors are joined in plain exchanges that adaptive execution may split.
    """
    gram = gram_matrix(fixed)
    rank = len(gram)
    own = solved.select("id", F.col("features").alias("x"))
    others = fixed.select(F.col("id").alias("other"), F.col("features").alias("y"))
    pairs = ratings.join(others, "other").join(own, "id").select("id", "rating", "x", "y")
    parts = written(_pair_sums(pairs, rank, alpha), "gradients")

    def added(batches):
        """Rows of one id lie together; a running sum is all that is held of them."""
        name, sums = None, None
        for batch in batches:
            pull, target = matrix_of(batch.column("pull"), rank), matrix_of(batch.column("target"), rank)
            counts = np.column_stack([batch.column(c).to_numpy() for c in ("n_pairs", "n_positive")])
            names = batch.column("id").to_numpy()
            first = np.flatnonzero(np.diff(names, prepend=names[0] - 1))
            rows = np.hstack([pull, target, counts])
            totals = np.add.reduceat(rows, first, axis=0)
            out = []
            for key, total in zip(names[first].tolist(), totals):
                if key == name:
                    sums = sums + total
                    continue
                if name is not None:
                    out.append((name, sums))
                name, sums = key, total
            yield _rows(out, rank)
        if name is not None:
            yield _rows([(name, sums)], rank)

    whole = map_columns(
        parts.repartition("id").sortWithinPartitions("id"), added,
        "id int, pull array<double>, target array<double>, n_pairs long, n_positive long",
    )

    def judged(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, pull, target = (matrix_of(batch.column(c), rank) for c in ("x", "pull", "target"))
            n = batch.column("n_positive").to_numpy()
            gradient = x @ gram + pull + (reg * n)[:, None] * x - target
            breach = np.where(x > 0, np.abs(gradient), np.maximum(-gradient, 0))
            scale = np.maximum(np.abs(target).max(axis=1), np.finfo(np.float64).tiny)
            # An id without targets is at its minimum at zero; there the gradient itself tells.
            violation = np.where(n > 0, breach.max(axis=1) / scale, breach.max(axis=1))
            yield {
                "id": batch.column("id"), "n_pairs": batch.column("n_pairs"), "violation": violation,
                "is_feasible": (x >= 0).all(axis=1),
            }

    checked = map_columns(
        whole.join(own, "id"), judged, "id int, n_pairs long, violation double, is_feasible boolean"
    )
    rated = ratings.select("id").distinct()
    return rated.join(checked, "id", "left").select(
        "id",
        F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"),
        "violation",
        F.coalesce("is_feasible", F.lit(False)).alias("is_feasible"),
        _within("violation", tolerance).alias("is_optimal"),
    )


def _within(column: str, tolerance: float) -> Column:
    return F.coalesce((F.col(column) <= tolerance) & ~F.isnan(column), F.lit(False))


def _rows(found: list, rank: int) -> dict:
    return {
        "id": [name for name, _ in found],
        "pull": [s[:rank] for _, s in found],
        "target": [s[rank : 2 * rank] for _, s in found],
        "n_pairs": [int(s[-2]) for _, s in found],
        "n_positive": [int(s[-1]) for _, s in found],
    }
