"""Every query against its SQL form; those without one are checked for shape and range."""

import pytest

import __spark_entry__ as contract

from .compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, db, key):
    got = contract.queries()[key](spark, FOLDER).toPandas()
    assert len(got) > 0
    assert differences(got, db.execute(contract.oracle_sql()[key]).df()) is None


# The paths that only large inputs take, forced on small ones.
LARGE = [
    "join_dimension", "join_lookup_map", "dense_rank_date", "global_row_index", "describe", "describe_by_class", "quantiles",
    "box_stats", "histogram", "rare_to_others", "label_encode", "label_encode_fit_transform", "value_counts_normalized",
    "split_random", "split_stratified", "split_time_series", "split_group_kfold", "split_leave_p_groups_out",
    "split_stratified_kfold", "sample_under", "sample_over", "auc_roc", "ks_histogram_categorical", "low_cardinality_columns",
]


@pytest.mark.parametrize("key", LARGE)
def test_same_as_sql_without_broadcast(spark, db, shuffled, key):
    got = contract.queries()[key](spark, FOLDER).toPandas()
    assert differences(got, db.execute(contract.oracle_sql()[key]).df()) is None


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("key", ["gbt_train_cv", "gbt_train_full", "gbt_train_time_cv", "time_split_evaluation"])
def test_learnable_label_is_learned(spark, key):
    rows = contract.queries()[key](spark, FOLDER).toPandas()
    assert (rows["auc"] > 0.9).all() and (rows["auc"] <= 1.0).all()


def test_cross_validation_grows_all_trees(spark, monkeypatch):
    from tabloom.operators import models

    grown = []
    monkeypatch.setattr(models.LeafwiseModel, "save", lambda self, *_: grown.append(len(self.trees)))
    assert contract.queries()["gbt_train_cv"](spark, FOLDER).count() == 3
    assert grown == [models.DEFAULT_BOOSTER["n_estimators"]] == [512]


def test_predictions_are_probabilities_per_key(spark):
    rows = contract.queries()["gbt_predict"](spark, FOLDER).toPandas()
    assert rows["vec_id"].is_unique and rows["score"].between(0, 1).all() and len(rows) == 500


def test_importances_are_total_gains(spark):
    rows = contract.queries()["feature_importance"](spark, FOLDER).toPandas()
    assert set(rows["feature"]) == {"l_quantity", "l_discount", "l_tax", "l_linenumber"} and (rows["importance"] >= 0).all()
    assert rows["importance"].is_monotonic_decreasing and rows["feature"][0] == "l_quantity"


def test_search_is_sorted_by_score(spark):
    rows = contract.queries()["hyperparam_search"](spark, FOLDER).toPandas()
    assert rows["score"].is_monotonic_decreasing and sorted(rows["trial"]) == list(range(20))


@pytest.mark.parametrize("key", ["feature_time_consistency", "feature_consistency_report"])
def test_time_consistency_flags_below_one_half(spark, key):
    rows = contract.queries()[key](spark, FOLDER).toPandas().set_index("feature")
    assert rows.loc["l_quantity", "auc"] > 0.9
    assert ((rows["auc"] < 0.5) == rows["flagged"]).all()


@pytest.mark.parametrize("key", ["svm_train_score", "mlp_train_score"])
def test_trained_classifiers_beat_chance(spark, key):
    rows = contract.queries()[key](spark, FOLDER).toPandas().set_index("role")
    assert set(rows.index) == {"train", "test"}
    assert rows.loc["train", "accuracy"] > 0.7 and rows.loc["test", "accuracy"] > 0.5


def test_chained_imputation_fills_and_keeps_what_was_there(spark):
    rows = contract.queries()["impute_chained_many"](spark, FOLDER)
    assert rows.na.drop().count() == rows.count() == spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
