"""Chained imputation against a plain version that fills a matrix round by round."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import chained
from tabloom.operators.prepare import impute_chained

NAMES = ["a", "b", "c", "d"]


def plain_ridge(x, y):
    n = len(y)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    noise, penalty, old = 1 / (y.var() + np.finfo(float).eps), 1.0, None
    for _ in range(300):
        w = vt.T @ (s / (s**2 + penalty / noise) * (u.T @ y))
        gamma = (noise * s**2 / (penalty + noise * s**2)).sum()
        penalty = (gamma + 2e-6) / ((w**2).sum() + 2e-6)
        noise = (n - gamma + 2e-6) / (((y - x @ w) ** 2).sum() + 2e-6)
        if old is not None and np.abs(old - w).sum() < 1e-3:
            break
        old = w
    return vt.T @ (s / (s**2 + penalty / noise) * (u.T @ y))


def plain_chained(x, rounds, tol, ridge=True):
    missing = np.isnan(x)
    mean = np.nanmean(x, axis=0)
    filled = np.where(missing, mean, x)
    order = sorted((j for j in range(x.shape[1]) if missing[:, j].any()), key=lambda j: missing[:, j].sum())
    reach = max(np.nanstd(x[:, j]) for j in range(x.shape[1]))
    for _ in range(rounds):
        moved = 0.0
        for j in order:
            rest = [i for i in range(x.shape[1]) if i != j]
            rows = ~missing[:, j]
            left, right = filled[rows][:, rest], x[rows, j]
            lm, rm = left.mean(axis=0), right.mean()
            w = plain_ridge(left - lm, right - rm) if ridge else np.linalg.lstsq(left - lm, right - rm, rcond=None)[0]
            new = rm + (filled[~rows][:, rest] - lm) @ w
            moved = max(moved, np.sqrt(((new - filled[~rows, j]) ** 2).mean()))
            filled[~rows, j] = new
        if moved <= tol * reach:
            break
    return filled


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(3)
    z = rng.normal(size=(600, 2))
    x = np.stack([z[:, 0] * 3 + 10, z[:, 0] - z[:, 1], z[:, 1] * 5 + rng.normal(size=600), rng.normal(size=600) + z[:, 0]], axis=1)
    hidden = rng.uniform(size=x.shape) < np.array([0.0, 0.15, 0.3, 0.2])
    return np.where(hidden, np.nan, x)


@pytest.fixture(scope="module")
def frame(spark, matrix):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(matrix)]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, d double").withColumn("other", F.lit("kept"))


def filled(df, names=NAMES, **settings):
    out = impute_chained(df, names, **settings).orderBy("key")
    assert out.columns == df.columns
    return np.array([[r[n] for n in names] for r in out.collect()], dtype=float)


@pytest.mark.parametrize("cells", [chained.PATTERN_CELLS, 0], ids=["patterns", "scans"])
@pytest.mark.parametrize("rounds, tol, regression", [(1, 0.0, "ridge"), (4, 0.0, "ridge"), (10, 1e-3, "ridge"), (3, 0.0, "least_squares")])
def test_imputation_is_the_plain_one(frame, matrix, monkeypatch, cells, rounds, tol, regression):
    monkeypatch.setattr(chained, "PATTERN_CELLS", cells)
    found = filled(frame.repartition(5), rounds=rounds, tol=tol, regression=regression)
    assert np.abs(found - plain_chained(matrix, rounds, tol, regression == "ridge")).max() < 1e-6
    there = ~np.isnan(matrix)
    assert (found[there] == matrix[there]).all()


def test_rounds_read_no_rows(spark, frame):
    """One scan finds the patterns, one their sums, one writes: the number of jobs is the same for one round and for ten."""
    def jobs(rounds):
        group = f"rounds-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        impute_chained(frame, NAMES, rounds=rounds, tol=0.0)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext._jsc.clearJobGroup()
        return found

    assert jobs(1) == jobs(10)


def test_many_sums_are_handed_on_in_parts(frame, matrix, monkeypatch):
    monkeypatch.setattr(chained, "TASK_CELLS", 0)
    assert np.abs(filled(frame.repartition(9), rounds=2, tol=0.0) - plain_chained(matrix, 2, 0.0)).max() < 1e-6


def test_hard_columns(spark):
    schema = "key long, a double, b int, c double"
    rows = [(1, 1.0, 2, None), (2, float("nan"), 4, None), (3, 3.0, None, None), (4, 5.0, 10, None)]
    out = impute_chained(spark.createDataFrame(rows, schema), ["a", "b", "c"], regression="least_squares").orderBy("key").collect()
    assert [r.c for r in out] == [None] * 4
    assert out[1].a == pytest.approx(2.0, abs=0.1) and out[2].b == pytest.approx(6.0, abs=0.2)
    assert impute_chained(spark.createDataFrame([], schema), ["a", "b"]).count() == 0
    alone = impute_chained(spark.createDataFrame(rows, schema), ["a"]).orderBy("key").collect()
    assert [r.a for r in alone] == [1.0, 3.0, 3.0, 5.0]
    whole = spark.createDataFrame([(1, 1.0, 2, 3.0), (2, 2.0, 3, 5.0)], schema)
    assert [tuple(r) for r in impute_chained(whole, ["a", "c"]).orderBy("key").collect()] == [(1, 1.0, 2, 3.0), (2, 2.0, 3, 5.0)]
