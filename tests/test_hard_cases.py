"""Empty lists, columns without spread, ties and texts that a format must quote."""

import datetime

import pytest

from tabloom.operators import prepare, profile, sampling, stats
from tabloom.session import measured_size, scratch_path
from tabloom.sources import csv_scan_inferred, csv_scan_typed, csv_sink, parquet_scan


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(1.0, 2.0, 5.0, "a"), (2.0, 4.1, 5.0, "a"), (3.0, 5.9, 5.0, "b"), (4.0, 8.0, 5.0, "b")],
                                 "x double, y double, c double, g string")


def test_csv_keeps_line_breaks_quotes_empty_and_missing_texts(spark):
    rows = [(1, "a\nb"), (2, ""), (3, None), (4, 'say "hi", ok'), (5, " x "), (6, "\\")]
    path = scratch_path(spark, "csv")
    csv_sink(spark.createDataFrame(rows, "k int, v string"), path)
    assert sorted(map(tuple, csv_scan_typed(spark, path, "k int, v string").collect())) == rows
    assert sorted(map(tuple, csv_scan_inferred(spark, path).collect())) == rows


def test_parquet_scan_reads_nan_as_missing(spark):
    path = scratch_path(spark, "nan")
    spark.createDataFrame([(float("nan"),), (1.0,)], "v double").write.parquet(path)
    assert sorted(map(tuple, parquet_scan(spark, path).collect()), key=str) == [(1.0,), (None,)]


@pytest.mark.parametrize("extra", [0, 38])
def test_constant_column_has_no_correlation_at_any_width(spark, small, extra):
    wide = small.selectExpr("x", "c", *[f"x * {i + 2} AS e{i}" for i in range(extra)])
    rows = {(r[0], r[1]): r[2] for r in profile.corr_pairs(wide, wide.columns).collect()}
    assert rows["c", "x"] is None
    assert len(rows) == len(wide.columns) * (len(wide.columns) - 1) // 2


def test_correlation_of_one_column_or_no_rows(small):
    assert profile.corr_pairs(small, ["x"]).count() == 0
    assert [r["abs_r"] for r in profile.corr_pairs(small.limit(0), ["x", "y"]).collect()] == [None]


def test_anova_and_t_without_spread_or_groups(small):
    assert stats.anova_oneway(small, "c", "g").first()["f"] is None
    assert stats.anova_oneway(small.filter("g = 'a'"), "x", "g").first()["f"] is None
    assert stats.anova_oneway(small.limit(0), "x", "g").first()["p"] is None
    assert stats.ttest_independent(small, "c", "g", "a", "b").first()["t"] is None
    assert stats.ttest_independent(small, "x", "g", "a", "z").first()["p"] is None


def test_empty_lists_change_nothing(small):
    for same in (prepare.rare_to_others(small, {}), prepare.zscore(small, []), prepare.label_encode(small, []),
                 prepare.impute_mean(small, []), prepare.impute_mode(small, []), prepare.skew_log_transform(small, [])):
        assert same.columns == small.columns and same.count() == 4


def test_mode_breaks_ties_by_number_and_not_by_text(spark):
    df = spark.createDataFrame([(9.0,), (9.0,), (10.0,), (10.0,), (None,)], "v double")
    assert prepare.impute_mode(df, ["v"]).filter("v = 9").count() == 3


def test_calendar_buckets(spark):
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 31),), (datetime.datetime(2024, 2, 1),), (datetime.datetime(2024, 2, 29),)], "ts timestamp")
    rows = {r["bucket_start"]: r["rows"] for r in profile.count_per_time_bucket(df, "ts", "1 month").collect()}
    assert rows == {datetime.datetime(2024, 1, 1): 1, datetime.datetime(2024, 2, 1): 2}


def test_synthetic_sampling_refuses_what_it_cannot_balance(spark):
    rows = [(i, float(i), int(i == 0)) for i in range(20)]
    with pytest.raises(ValueError):
        sampling.sample_smote(spark.createDataFrame(rows, "k int, x double, y int"), ["x"], "k", "y").count()
    rows = [(i, None if i == 1 else float(i), int(i < 4)) for i in range(20)]
    with pytest.raises(ValueError):
        sampling.sample_smote(spark.createDataFrame(rows, "k int, x double, y int"), ["x"], "k", "y").count()


def test_size_check_uses_no_single_task(spark):
    table = spark.range(1000).repartition(4)
    assert measured_size(table, 10)[0] == 1000
