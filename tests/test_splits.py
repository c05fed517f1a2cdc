"""Folds against known assignments over twelve points, and their invariants on skewed groups."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabloom.operators import splits as X
from tabloom.operators.sampling import sample_over, sample_under

# Twelve points (x0, x1, class, group).
POINTS = [
    (3.54934659, 0.6925054, 1, 0), (1.9263585, 4.15243012, 0, 0), (0.0058752, 4.38724103, 2, 0),
    (1.12031365, 5.75806083, 0, 1), (1.7373078, 4.42546234, 0, 1), (2.36833522, 0.04356792, 1, 1),
    (-0.49772229, 1.55128226, 1, 1), (-1.4811455, 2.73069841, 2, 2), (0.87305123, 4.71438583, 0, 2),
    (-0.66246781, 2.17571724, 2, 3), (0.74285061, 1.46351659, 2, 3), (2.49913075, 1.23133799, 1, 3),
]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(POINTS)], "i int, x0 double, x1 double, y int, g int")


def _groups_per_fold(df):
    rows = df.groupBy("fold").agg(F.array_sort(F.collect_set("g")).alias("gs")).orderBy("fold").collect()
    return [tuple(r["gs"]) for r in rows]


@pytest.mark.parametrize("k, folds", [
    (2, [(1, 2), (0, 3)]), (3, [(1,), (2, 3), (0,)]), (4, [(1,), (3,), (0,), (2,)])])
def test_group_folds(points, k, folds):
    assert _groups_per_fold(X.split_group_kfold(points, "g", k)) == folds


def test_more_folds_than_groups(points):
    with pytest.raises(ValueError, match="greater than the number of groups: 4"):
        X.split_group_kfold(points, "g", 5)


def test_leave_one_group_out(points):
    assert _groups_per_fold(X.split_leave_one_group_out(points, "g")) == [(0,), (1,), (2,), (3,)]


def test_leave_two_groups_out(points):
    folds = X.split_leave_p_groups_out(points, "g", 2).orderBy("fold").collect()
    assert [tuple(r["test_groups"]) for r in folds] == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
    assert [r["fold"] for r in folds] == list(range(6))


def test_leave_three_groups_out(points):
    folds = X.split_leave_p_groups_out(points, "g", 3).orderBy("fold").collect()
    assert [tuple(r["test_groups"]) for r in folds] == [(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)]


def test_many_groups_of_few_sizes_fill_the_lightest_fold(spark):
    """Group g has 1 + g % 5 rows, one group a third of all: one by one gives the same folds."""
    sizes = {g: 1 + g % 5 for g in range(200)} | {200: 300}
    rows = [(g,) for g, n in sizes.items() for _ in range(n)]
    got = X.group_folds(spark.createDataFrame(rows, "g int"), "g", 4).toPandas().set_index("g")["fold"].to_dict()
    load, want = [0] * 4, {}
    for g in sorted(sizes, key=lambda g: (-sizes[g], -g)):
        want[g] = min(range(4), key=lambda f: (load[f], f))
        load[want[g]] += sizes[g]
    assert got == want


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"),
                                    F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("t"))


def test_random_split_size_and_repeatability(skewed):
    one = X.split_random(skewed, "id", 0.2, 5)
    two = X.split_random(skewed.repartition(7), "id", 0.2, 5)
    assert one.filter("role = 'test'").count() == math.ceil(0.2 * 1003)
    assert {r["id"] for r in one.filter("role = 'test'").collect()} == {r["id"] for r in two.filter("role = 'test'").collect()}


def test_stratified_split_sizes(skewed):
    got = {(r["y"], r["role"]): r["count"] for r in X.split_stratified(skewed, "id", "y", 0.33, 1).groupBy("y", "role").count().collect()}
    for y, n in ((0, 902), (1, 101)):
        assert got[y, "test"] == math.ceil(0.33 * n) and got[y, "train"] == n - math.ceil(0.33 * n)


@pytest.mark.parametrize("k", [2, 5])
def test_time_series_windows(skewed, k):
    got = X.split_time_series(skewed, ["t", "id"], k)
    sizes = Counter(r["fold"] for r in got.collect())
    assert all(sizes[f] == 1003 // (k + 1) for f in range(1, k + 1)) and sum(sizes.values()) == 1003
    rows = sorted(got.collect(), key=lambda r: (r["t"], r["id"]))
    assert [r["fold"] for r in rows] == sorted(r["fold"] for r in rows)


def test_time_series_of_too_few_rows(points):
    with pytest.raises(ValueError, match="too few"):
        X.split_time_series(points, "i", 20)


def test_stratified_folds_are_even_per_class(skewed):
    sizes = Counter((r["y"], r["fold"]) for r in X.split_stratified_kfold(skewed, "id", "y", 5, 1).collect())
    for y, n in ((0, 902), (1, 101)):
        per = [sizes[y, f] for f in range(5)]
        assert sum(per) == n and max(per) - min(per) <= 1


def test_resampling_gives_equal_classes(skewed):
    for sample in (sample_under, sample_over):
        counts = [r["count"] for r in sample(skewed, "id", "y", 2).groupBy("y").count().collect()]
        assert len(set(counts)) == 1
    assert sample_under(skewed, "id", "y", 2).select("id").distinct().count() == 202


def test_fold_sizes_add_up(points):
    rows = X.fold_sizes(X.split_group_kfold(points, "g", 3), "fold", "g").collect()
    for f in range(3):
        assert sum(r["rows"] for r in rows if r["fold"] == f) == 12
        assert sum(r["groups"] for r in rows if r["fold"] == f) == 4
