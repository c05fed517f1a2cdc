"""Physical plans: what must not be shuffled is not, filters reach the scan, nothing is crossed."""

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"


def plan(spark, key: str) -> str:
    return contract.queries()[key](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


# Once the cut, the statistics or the lookup table is known, these are a map over the rows.
MAPS = [
    "split_random", "split_stratified", "split_stratified_kfold", "split_time_series", "sample_under", "impute_mean",
    "impute_mode", "zscore", "skew_log_transform", "narrow_types", "filter_range_quantile", "dense_rank_date",
    "dense_rank_year_month", "label_encode", "rare_to_others", "trend_slope", "threshold_labels", "drop_cols_null_count",
]


@pytest.mark.parametrize("key", MAPS)
def test_rows_are_not_shuffled(spark, key):
    text = plan(spark, key)
    if key in ("trend_slope",):
        # the yearly table itself is an aggregate of orders; the trend adds nothing to it
        assert text.count("Exchange hashpartitioning") <= 3
        return
    # The cases view is a join of its own.
    joins_of_input = 2 if key in ("label_encode", "impute_mode") else 0
    assert text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") <= joins_of_input
    assert "SinglePartition" not in text


def test_quantile_filter_reaches_the_scan(spark):
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value" in plan(spark, "filter_range_quantile")


def test_only_used_columns_are_read(spark):
    text = plan(spark, "value_counts")
    assert "ReadSchema: struct<source:string>" in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in plan(spark, "column_mean_std")


@pytest.mark.parametrize("key", [
    "key_overlap", "join_outer", "corr_pairs", "split_leave_p_groups_out", "sample_over", "sample_smote", "box_stats",
    "ks_histogram_numeric", "auc_roc", "high_corr_drop_list", "confusion_matrix"])
def test_nothing_is_crossed(spark, key):
    text = plan(spark, key)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_k_is_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_k") and "rangepartitioning" not in plan(spark, "top_k")


def test_distinct_keys_combine_before_the_shuffle(spark):
    text = plan(spark, "dedup_keep_first")
    assert "partial_min" in text and "Window" not in text


def test_preparation_is_fitted_once_and_applied_to_tables_without_a_label(spark):
    from tabloom.plans.preparation import Preparation

    train = spark.createDataFrame([(i, i % 2, float(i * 86400), float(i), "ab"[i % 2]) for i in range(8)], "k int, y int, s double, x double, g string")
    test = spark.createDataFrame([(100, 86400.0, None, "a"), (101, 0.0, 3.0, "z")], "k int, s double, x double, g string")
    known = spark.createDataFrame([(i, "u") for i in (0, 1, 2, 3, 4, 100)], "k int, h string")
    fitted = Preparation("k", "y", "s", max_corr=1.1).fit(train, known)
    assert fitted.train.count() == 8 and set(fitted.train.columns) == {"k", "y", "s", "x", "g", "h", "DT_M"}
    rows = {r["k"]: r for r in fitted.transform(test, known).collect()}
    assert rows[100]["x"] == 3.5 and rows[100]["g"] == 0 and rows[101]["g"] is None
    assert "y" not in rows[100].asDict() and rows[101]["h"] == 0
