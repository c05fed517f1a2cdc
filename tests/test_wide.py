"""Operators that look at many columns side by side, against plain versions; the paths of many classes, tiles and slices."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom import ordering
from tabloom.functions import fn_as_string
from tabloom.operators import correlate, metrics, profile, relational
from tabloom.ordering import quantile_table, sliced_index


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = pd.DataFrame({"a": rng.normal(size=3000), "b": rng.integers(0, 9, 3000).astype(float), "c": np.full(3000, 0.1), "none": np.full(3000, np.nan)})
    x.loc[rng.uniform(size=3000) < 0.3, "a"] = np.nan
    x["d"] = x["a"] * 2 + x["b"]
    x["g"] = rng.integers(0, 5, 3000)
    x["id"] = range(3000)
    schema = "a double, b double, c double, none double, d double, g long, id long"
    return x, spark.createDataFrame(x, schema).repartition(6).persist()


@pytest.mark.parametrize("classes", [64, 0], ids=["constants", "joined"])
@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_describe_keeps_every_column_and_is_exact(table, monkeypatch, classes, accuracy):
    x, df = table
    monkeypatch.setattr(ordering, "CLASS_LITERALS", classes)
    monkeypatch.setattr(ordering, "HELD_VALUES", 50)
    names = ["a", "b", "c", "none", "d"]
    by = "g"
    got = {(r["g"], r["column_name"]): r for r in quantile_table(
        df, names, [0.25, 0.5, 0.75], by, {"count": F.count, "mean": F.avg}, ["q25", "q50", "q75"], accuracy).collect()}
    assert len(got) == 5 * len(names)
    for g, part in x.groupby("g"):
        for n in names:
            r, v = got[g, n], part[n].dropna()
            assert r["count"] == len(v)
            if len(v):
                assert np.allclose([r["mean"], r["q25"], r["q50"], r["q75"]], [v.mean(), *np.quantile(v, [0.25, 0.5, 0.75])], rtol=1e-12)
            else:
                assert r["mean"] is r["q50"] is None


def test_describe_without_classes_and_without_rows(spark, table):
    x, df = table
    got = {r.column_name: r for r in profile.describe(df, ["a", "none"]).collect()}
    assert got["none"]["count"] == 0 and got["none"].mean is None and got["none"].max is None
    assert math.isclose(got["a"].q50, x["a"].median()) and got["a"]["max"] == x["a"].max()
    empty = profile.describe(df.limit(0), ["a"]).collect()
    assert [(r.column_name, r["count"], r.q50) for r in empty] == [("a", 0, None)]
    assert profile.describe(df.limit(0), ["a"], "g").count() == 0


def test_describe_reads_the_table_twice_and_melts_nothing(spark, table, tmp_path):
    df = table[1]
    path = str(tmp_path / "t")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    seen = []
    plain = ordering._bracketed_values
    try:
        ordering._bracketed_values = lambda facts, b: seen.append(facts) or plain(facts, b)
        spark.sparkContext.setJobGroup("describe", "describe")
        profile.describe(stored, ["a", "b", "d"]).collect()
        spark.sparkContext._jsc.clearJobGroup()
    finally:
        ordering._bracketed_values = plain
    assert len(seen) == 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("classes", [64, 0], ids=["constants", "joined"])
@pytest.mark.parametrize("by", [None, "g"])
def test_histograms_count_every_bin(table, monkeypatch, classes, by):
    x, df = table
    if by is None and classes == 0:
        pytest.skip("one class is always a constant")
    monkeypatch.setattr(ordering, "CLASS_LITERALS", classes)
    got = {}
    for r in profile.histograms(df, ["a", "b", "c", "none"], 7, by).collect():
        got.setdefault((r["g"] if by else None, r.column_name), []).append((r.bin, r["count"], r.bin_low, r.bin_high))
    for g, part in (x.groupby("g") if by else [(None, x)]):
        assert (g, "none") not in got
        for n in "abc":
            counts, ends = np.histogram(part[n].dropna(), bins=7)
            rows = sorted(got[g, n])
            assert [r[1] for r in rows] == counts.tolist()
            assert np.allclose([rows[0][2], *[r[3] for r in rows]], ends)


@pytest.mark.parametrize("block, tiles", [(128, 128), (2, 2), (1, 3)])
def test_correlations_are_the_same_in_any_tiling(table, monkeypatch, block, tiles):
    x, df = table
    monkeypatch.setattr(correlate, "BLOCK", block)
    monkeypatch.setattr(correlate, "TILES_A_SCAN", tiles)
    names = ["d", "b", "a", "c", "none", "id"]
    got = {(r.column_a, r.column_b): r.r for r in correlate.pairwise_correlations(df, names).collect()}
    want = x[names].corr()
    assert set(got) == {(a, b) for a in names for b in names if a < b}
    for (a, b), r in got.items():
        if "c" in (a, b) or "none" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-12)


def test_correlations_of_nothing_and_of_one_column(spark, table):
    df = table[1]
    assert [tuple(r) for r in correlate.pairwise_correlations(df.limit(0), ["a", "b"]).collect()] == [("a", "b", None)]
    assert correlate.pairwise_correlations(df, ["a"]).count() == 0


def test_a_value_that_is_constant_among_the_joint_rows_has_no_correlation(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0), (7.0, None)], "x double, y double")
    assert correlate.pairwise_correlations(df, ["x", "y"]).first().r is None


def test_two_thousand_columns_agree_with_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 2000))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").select(*[F.col("v")[i].alias(f"n{i:04d}") for i in range(2000)])
    want = np.corrcoef(x, rowvar=False)
    got = correlate.pairwise_correlations(df, df.columns)
    picked = got.filter("column_a IN ('n0000', 'n0127', 'n1500')").collect()
    assert len(picked) == 1999 + 1999 - 127 + 499
    assert max(abs(r.r - want[int(r.column_a[1:]), int(r.column_b[1:])]) for r in picked) < 1e-9


# ---- positions ------------------------------------------------------------------------


@pytest.mark.parametrize("slices", [2000, 0], ids=["constants", "written"])
def test_row_index_over_ties_missing_keys_and_hot_values(spark, monkeypatch, slices):
    monkeypatch.setattr(ordering, "MOST_SLICES", slices)
    rows = [(None if i % 11 == 0 else 5.0 if i % 3 else float(i % 17), f"k{i:05d}" if i % 13 else None, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "x double, s string, id long").repartition(9)
    got = {r.id: r.row_index for r in sliced_index(df, ["x", "s", "id"]).collect()}
    ordered = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0.0), (r[1] is not None, r[1] or ""), r[2]))
    assert got == {r[2]: i for i, r in enumerate(ordered)}
    assert sliced_index(df.limit(0), "x").count() == 0


def test_row_index_writes_nothing_and_reads_only_what_is_asked_for(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5000).selectExpr("id", "(id * 7919) % 5000 AS place", "concat('x', id) AS text").write.parquet(path)
    indexed = sliced_index(spark.read.parquet(path), "place")
    plan = indexed.select("id", "row_index")._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "text" not in plan and plan.count("Exchange") == 1
    assert indexed.filter("row_index <> place").count() == 0


# ---- texts, classes and folds -----------------------------------------------------------


def test_numbers_as_text_have_plain_decimals(spark):
    values = [12345678.0, 1e16, 1.5e-5, 1e-4, 0.0001234567890123456, -1.2345678e7, 123456789012345.6, 1e300, -2.5e-300, 0.0, 100.0, 2e7, 1.0, float("inf"),
              float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(fn_as_string(F.col("v")).alias("s"))
    assert [r.s for r in df.collect()] == ["nan" if v is None else str(v) for v in values]
    row = spark.range(1).select(fn_as_string(F.lit(7)), fn_as_string(F.lit("1.5E7")), fn_as_string(F.lit(None).cast("string"))).first()
    assert tuple(row) == ("7", "1.5E7", "nan")


def test_columns_without_values_are_of_low_cardinality(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, None, "c"), (2, None, None)], "x int, z double, t string")
    got = {r.column_name: (r.distinct_values, r["values"]) for r in relational.low_cardinality_columns(df, ["x", "z", "t"]).collect()}
    assert got == {"x": (2, "1,2"), "z": (0, "")}
    many = spark.range(5000).selectExpr("id", "id % 2 AS bit")
    assert [r.column_name for r in relational.low_cardinality_columns(many, ["id", "bit"]).collect()] == ["bit"]
    assert relational.low_cardinality_columns(many, ["id"]).count() == 0


def test_scores_per_fold_are_those_of_the_fold_alone(spark):
    rows = [(i % 3, (i * 7 % 5) % 2, ((i * 13) % 10) / 10) for i in range(300)] + [(3, 1, 0.9)]
    df = spark.createDataFrame(rows, "fold int, y int, score double")
    got = {(r.fold, r.metric, r.average): r.value for r in metrics.fold_scores(df, "y", "score", "fold").collect()}
    for fold in range(4):
        mine = metrics.threshold_labels(df.filter(F.col("fold") == fold), "score", "p")
        for name, f in (("precision", metrics.precision_scores), ("recall", metrics.recall_scores), ("f1", metrics.f1_scores)):
            alone = {r.average: r.value for r in f(mine, "y", "p").collect()}
            assert {a: v for (k, m, a), v in got.items() if (k, m) == (fold, name)} == alone
