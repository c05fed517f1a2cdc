"""Edge cases and known values of single operators."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom import sources as S
from tabloom.columns import Roles
from tabloom.functions import scalars as C
from tabloom.operators import metrics as M
from tabloom.operators import prepare as E
from tabloom.operators import profile as P
from tabloom.operators import relational as R
from tabloom.operators import sampling
from tabloom.operators import stats as T
from tabloom.operators.ranks import day_ordinal_offset, dense_rank_date
from tabloom.session import scratch_path


def _rows(df):
    return [tuple(r) for r in df.collect()]


# ---- tests and trends -----------------------------------------------------------------


def test_f_tail_of_the_protein_table():
    """F = 62.08 over 8 classes of 1077 measurements."""
    assert T.f_tail(62.08, 7, 1069) == pytest.approx(5.92e-75, rel=0.05)


def test_tails_at_known_points():
    assert T.t_tail(2.0, 10) == pytest.approx(0.07338803, rel=1e-6)
    assert T.f_tail(4.0, 1, 10) == pytest.approx(T.t_tail(2.0, 10), rel=1e-12)
    assert T.f_tail(0.0, 3, 20) == 1.0


def test_ks_table_is_the_lattice_count():
    """Share of the orders of ten and ten values whose steps drift at least D apart."""
    total = {}
    for limit in range(1, 11):
        ways = {(0, 0): 1}
        for i, j in itertools.product(range(11), range(11)):
            if (i, j) != (0, 0):
                ways[i, j] = 0 if abs(i - j) >= limit else ways.get((i - 1, j), 0) + ways.get((i, j - 1), 0)
        total[limit] = 1 - ways[10, 10] / 184756
    for d in range(1, 11):
        assert T.KS_TEN_BY_TEN[d] == pytest.approx(total[d], rel=1e-6), d


def test_flat_histogram_has_no_ks(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 2.0), (None, 9.0)], "y int, v double")
    (row,) = T.ks_histogram_numeric(df.withColumn("w", F.lit(3.0)), ["v", "w"], "y").filter("column_name = 'w'").collect()
    assert row["d"] is not None  # one bin holds all rows: the heights are not flat
    even = spark.createDataFrame([(y, float(v)) for y in (0, 1) for v in range(10)], "y int, v double")
    (row,) = T.ks_histogram_categorical(even.withColumn("v", F.col("v").cast("int").cast("string")), ["v"], "y").collect()
    assert row["d"] is None and row["p"] is None


def test_trend_of_one_company(spark):
    row = [("MMM", "31,712,000", "32,136,000", "32,765,000", "31,657,000")]
    df = spark.createDataFrame(row, "symbol string, `1` string, `2` string, `3` string, `4` string")
    assert _rows(T.trend_slope(df, "symbol", ["4", "3", "2", "1"])) == [("MMM", pytest.approx(-46400.0))]
    fitted = T.trend_fitted(df, "symbol", ["4", "3", "2", "1"]).first()
    assert fitted["fitted_mean"] == pytest.approx((31712 + 32136 + 32765 + 31657) * 1000 / 4)
    assert fitted["fitted_3"] - fitted["fitted_0"] == pytest.approx(3 * -46400.0)


def test_trend_skips_missing_periods(spark):
    df = spark.createDataFrame([("A", "1", None, "5"), ("B", None, None, "2")], "s string, a string, b string, c string")
    assert _rows(T.trend_slope(df, "s", ["a", "b", "c"])) == [("A", 2.0), ("B", None)]


# ---- profiles -------------------------------------------------------------------------


def test_wide_null_profile_and_pruning(spark):
    """434 columns, column i missing in i * 100 / 433 percent of the rows."""
    wide = spark.range(433).select("id", *[F.when(F.col("id") >= i, 1.0).alias(f"c{i}") for i in range(433)])
    profile = {r["column_name"]: r["nan_percent"] for r in P.null_profile(wide).collect()}
    assert len(profile) == 434 and profile["id"] == 0 and profile["c432"] == pytest.approx(432 * 100 / 433)
    assert set(R.drop_cols_null_pct(wide, 50).columns) == {"id", *[f"c{i}" for i in range(433) if i * 100 / 433 <= 50]}


def test_correlation_by_tiles_is_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5)) + 1e6
    x[:, 1] += x[:, 0]
    x[rng.random((400, 5)) < 0.2] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    names = list("abcde")
    pairs = list(itertools.combinations(names, 2))
    row = df.agg(*[F.corr(p, q).alias(f"{p}{q}") for p, q in pairs]).first()
    narrow = {(p, q): row[f"{p}{q}"] for p, q in pairs}
    wide = {(r[0], r[1]): r[2] for r in P.pairwise_correlations(df, names).collect()}
    for pair in pairs:
        assert wide[pair] == pytest.approx(narrow[pair], abs=1e-9)


def test_histogram_of_a_constant_and_of_the_maximum(spark):
    one = _rows(P.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 10).orderBy("bin"))
    assert one[0][1] == 1.5 and one[-1][2] == 2.5 and [r[3] for r in one] == [0, 0, 0, 0, 0, 3, 0, 0, 0, 0]
    top = _rows(P.histogram(spark.createDataFrame([(float(i),) for i in range(11)], "v double"), "v", 10).orderBy("bin"))
    assert [r[3] for r in top] == [1] * 9 + [2]


def test_remaining_nulls_raise(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(ValueError, match="1 missing"):
        P.null_total_assert(df)
    assert _rows(P.null_total_assert(df.select("a"))) == [(0,)]


def test_key_counts(spark):
    a, b = spark.range(1000).withColumnRenamed("id", "k"), spark.range(250).withColumnRenamed("id", "k")
    assert _rows(R.key_overlap(a, b.union(b), "k")) == [(250, 750, 0)]
    assert _rows(P.count_of_counts(b, "k")) == [(1, 250)]


def test_time_buckets_on_a_stream(spark, tmp_path):
    batch = spark.range(100).select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id") * 30)).alias("ts"))
    path = str(tmp_path / "in")
    batch.write.parquet(path)
    stream = P.count_per_time_bucket(spark.readStream.schema(batch.schema).parquet(path), "ts", "10 minutes")
    query = stream.writeStream.outputMode("complete").format("memory").queryName("buckets").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(_rows(spark.table("buckets"))) == sorted(_rows(P.count_per_time_bucket(batch, "ts", "10 minutes")))


# ---- cleaning and encoding ------------------------------------------------------------


def test_missing_text_is_a_category_and_unseen_is_null(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    assert sorted(_rows(E.label_encode(fit, ["c"]))) == [(0,), (0,), (1,), (2,)]
    new = spark.createDataFrame([("a",), ("zz",)], "c string")
    assert _rows(E.label_encode(new, ["c"], fit_on=fit)) == [(0,), (None,)]


def test_label_codes_sort_by_code_point(spark):
    df = spark.createDataFrame([("b",), ("B",), ("a",), ("é",), ("10.0",), ("9.0",)], "c string")
    codes = {r["value"]: r["code"] for r in E.fit_label_codes(df, ["c"]).codes.collect()}
    assert sorted(codes, key=codes.get) == ["10.0", "9.0", "B", "a", "b", "é"]


def test_rare_values_and_missing_ones(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)], "c string")
    assert sorted(_rows(E.rare_to_others(df, {"c": 3})), key=str) == sorted([("a",)] * 5 + [("others",)] * 2 + [(None,)], key=str)


def test_mean_is_that_of_the_observed_values(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert sorted(_rows(E.impute_mean(df, ["v"]))) == [(1.0,), (2.0,), (3.0,)]


def test_chained_imputation_recovers_a_line(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("x"),
                                 F.when(F.col("id") % 4 != 0, F.col("id") * 2.0 + 1).alias("y"))
    filled = E.impute_chained(df, ["x", "y"], rounds=3).toPandas()
    assert np.abs(filled["y"] - (2 * filled["x"] + 1)).max() < 0.1


def test_narrowing_is_strict(spark):
    df = spark.createDataFrame([(126, 127, 32766, 40000, 1.5)], "a bigint, b bigint, c bigint, d bigint, e double")
    kinds = dict(E.narrow_types(df, df.columns).dtypes)
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "smallint", "d": "int", "e": "float"}


def test_drop_list_prefers_the_emptier_column_and_the_second_on_ties(spark):
    pairs = spark.createDataFrame([("a", "b", 0.99), ("a", "c", 0.9), ("c", "d", 0.85), ("b", "d", 0.1)],
                                  "column_a string, column_b string, abs_r double")
    nulls = spark.createDataFrame([("a", 5, 50.0), ("b", 0, 0.0), ("c", 5, 50.0)], "column_name string, null_count int, nan_percent double")
    # d is not profiled: it counts as complete
    assert _rows(E.high_corr_drop_list(pairs, nulls, 0.8).orderBy("position")) == [(1, "a"), (2, "c")]


def test_drops_are_strict_or_tolerant(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing_one"):
        R.drop_columns(df, ["missing_one"])
    assert R.drop_columns(df, ["missing_one", "b"], strict=False).columns == ["a"]


def test_day_numbers_start_after_the_offset(spark):
    df = spark.sql("SELECT timestamp'2018-01-01 10:00:00' AS ts UNION ALL SELECT timestamp'2018-01-01 23:00:00' "
                   "UNION ALL SELECT timestamp'2018-01-05 00:00:00' UNION ALL SELECT CAST(NULL AS timestamp)")
    assert sorted(r["day_ordinal"] for r in day_ordinal_offset(df, "ts").collect() if r["ts"]) == [365, 365, 366]
    ranks = {r["ts"]: r["day_rank"] for r in dense_rank_date(df, "ts").collect()}
    assert ranks[None] is None and sorted(v for v in ranks.values() if v) == [1, 1, 2]


def test_roles_come_from_types(spark):
    df = spark.createDataFrame([(1, "T", 2.0, 0)], "id bigint, m string, v double, y int")
    assert Roles.of(df, "id", "y") == Roles("id", "y", ("v",), ("m",))


# ---- scalars, sources -----------------------------------------------------------------


def test_scalar_functions(spark):
    one = spark.range(1)
    row = one.select(
        C.fn_strip_thousands(F.lit("31,657,000")).alias("a"), C.fn_strip_thousands(F.lit("n/a")).alias("b"),
        C.fn_concat_key(F.lit(None).cast("string"), F.lit(87.0)).alias("c"), C.fn_round_even(F.lit(0.5)).alias("d"),
        C.fn_round_even(F.lit(1.5)).alias("e"), C.fn_log10_shift(F.lit(-5.0), -5.0).alias("f"),
        C.fn_month_index(C.fn_start_plus_seconds(F.lit(86400), "2017-11-30")).alias("g")).first()
    assert tuple(row) == (31657000.0, None, "nan_87.0", 0.0, 2.0, 0.0, 12)


def test_csv_round_trip_keeps_missing_values(spark):
    df = spark.createDataFrame([(1, 1.5, "a,b"), (2, None, 'q"x'), (3, float("nan"), None)], "i int, v double, s string")
    back = S.csv_scan_typed(spark, S.csv_sink(df, scratch_path(spark, "csv")), df.schema)
    assert sorted(_rows(back)) == [(1, 1.5, "a,b"), (2, None, 'q"x'), (3, None, None)]


def test_stage_is_read_back_without_its_source(spark):
    path = scratch_path(spark, "stage")
    S.stage_snapshot(spark.range(5), path, "function")
    assert S.stage_snapshot(None, path, "stored", spark).count() == 5
    with pytest.raises(ValueError):
        S.stage_snapshot(None, path, "function", spark)


# ---- sampling and metrics -------------------------------------------------------------


@pytest.mark.parametrize("tile_bytes", [1, 32 * 1024 * 1024])
def test_neighbours_are_exact_over_any_tiling(spark, monkeypatch, tile_bytes):
    """600 points, a third of them the same one."""
    monkeypatch.setattr(sampling, "TILE_BYTES", tile_bytes)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    x[::3] = x[0]
    points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i long, x array<double>")
    queries = points.filter("i % 2 = 0").select(F.col("i").alias("q"), F.col("x").alias("qx"))
    got = {r["i"]: r["neighbours"] for r in sampling.nearest_neighbours(points, queries, 600, 3, 5).collect()}
    assert len(got) == 300
    for i, near in got.items():
        d = np.linalg.norm(x - x[i], axis=1)
        d[i] = np.inf
        assert i not in near and len(set(near)) == 5
        assert np.allclose(np.sort(d[near]), np.sort(d)[:5], atol=1e-6)


def test_smote_balances_and_stays_between_minority_rows(spark):
    rows = [(i, float(i % 50), 0) for i in range(100)] + [(1000 + i, 200.0 + i, 1) for i in range(8)]
    got = sampling.sample_smote(spark.createDataFrame(rows, "k long, v double, y int"), ["v"], "k", "y").toPandas()
    assert got["y"].value_counts().to_dict() == {0: 100, 1: 100}
    made = got[got["synthetic"]]
    assert len(made) == 92 and made["v"].between(200, 207).all() and (made["y"] == 1).all()


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (None, 0.3)], "y int, s double")
    assert _rows(M.auc_roc(df, "y", "s")) == [(0.875,)]
    one_class = df.filter("y = 1")
    assert _rows(M.auc_roc(one_class, "y", "s")) == [(None,)]


def test_scores_against_hand_counts(spark):
    """Truth 0 0 0 1 1 2, guess 0 0 1 1 2 1."""
    df = spark.createDataFrame(list(zip([0, 0, 0, 1, 1, 2], [0, 0, 1, 1, 2, 1])), "y int, p int")
    precision = {r[0]: r[1] for r in M.precision_scores(df, "y", "p").collect()}
    recall = {r[0]: r[1] for r in M.recall_scores(df, "y", "p").collect()}
    f1 = {r[0]: r[1] for r in M.f1_scores(df, "y", "p").collect()}
    assert precision["class_0"] == 1 and precision["class_1"] == pytest.approx(1 / 3) and precision["class_2"] == 0
    assert recall["macro"] == pytest.approx((2 / 3 + 1 / 2 + 0) / 3) and recall["micro"] == 0.5
    assert f1["weighted"] == pytest.approx((3 * 0.8 + 2 * 0.4 + 0) / 6)


def test_undefined_binary_scores_are_one(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    got = {r[0]: r[1] for r in M.precision_scores(df, "y", "p").collect()}
    assert got["binary"] == 1.0 and got["class_0"] == 0.5
