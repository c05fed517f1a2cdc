"""Exact neighbours by a metric index, against all distances."""

import numpy as np
import pytest

from tabloom.operators import sampling


def brute(x, asked, k):
    out = {}
    for i in asked:
        d = np.square(x - x[i]).sum(axis=1)
        out[i] = [j for j in np.lexsort((np.arange(len(x)), d)).tolist() if j != i][:k]
    return out


def found(spark, x, asked, k, visits=None):
    points = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i long, x array<double>").repartition(4)
    queries = spark.createDataFrame([(int(i), x[i].tolist()) for i in asked], "q long, qx array<double>").repartition(3)
    rows = sampling.nearest_neighbours(points, queries, len(x), x.shape[1], k, visits).collect()
    return {r.i: list(r.neighbours) for r in rows}


@pytest.mark.parametrize("cell, tile", [(2048, sampling.TILE_BYTES), (40, 0), (15, sampling.TILE_BYTES)])
def test_neighbours_are_exact(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(sampling, "CELL_ROWS", cell)
    monkeypatch.setattr(sampling, "TILE_BYTES", max(tile, 8 * 64))
    x = np.random.default_rng(1).integers(0, 12, size=(700, 3)).astype(float)  # many equal distances, many repeated points
    asked = list(range(0, 700, 3))
    assert found(spark, x, asked, 5) == brute(x, asked, 5)


def test_clustered_points_need_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CELL_ROWS", 50)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(50, 8)) * 0.05 + rng.normal(size=8) * 10 for _ in range(24)])
    visits = []
    assert found(spark, x, range(len(x)), 4, visits) == brute(x, range(len(x)), 4)
    assert sum(visits) < 0.25 * 24 * 24


def test_fewer_points_than_neighbours_and_hot_values(spark, monkeypatch):
    monkeypatch.setattr(sampling, "CELL_ROWS", 4)
    x = np.array([[1.0, 1.0]] * 9 + [[5.0, 5.0], [9.0, 0.0]])
    assert found(spark, x, [0, 9], 20) == brute(x, [0, 9], 20)
    assert found(spark, np.array([[1.0, 2.0]]), [0], 3) == {}
