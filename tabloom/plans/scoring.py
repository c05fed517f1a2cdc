"""From prepared train and test tables to a file of predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..operators.models import feature_importance, gbt_predict, gbt_train_cv, gbt_train_full, submission
from ..operators.sampling import sample_over, sample_smote, sample_under
from ..session import scratch_path
from ..sources import stage_snapshot


def balanced(train: DataFrame, how: str | None, names: Sequence[str], key: str, label: str, seed: int = 0) -> DataFrame:
    """The training rows, resampled as asked: 'under', 'over', 'smote' or not at all."""
    ways: dict[str | None, Callable[[], DataFrame]] = {
        None: lambda: train,
        "under": lambda: sample_under(train, key, label, seed),
        "over": lambda: sample_over(train, key, label, seed).drop("copy"),
        "smote": lambda: sample_smote(train, names, key, label, seed=seed).drop("synthetic"),
    }
    if how not in ways:
        raise ValueError(f"unknown resampling: {how}")
    return ways[how]()


def train_and_submit(
    train: DataFrame, test: DataFrame, template: DataFrame, names: Sequence[str], key: str, label: str, group: str,
    resampling: str | None = None, params: dict | None = None, k: int = 3,
) -> tuple[DataFrame, DataFrame, str]:
    """(metrics per group fold, feature importances, path of the submission).

    The folds judge the parameters; the submitted model is trained on all rows. Synthetic rows
    take their group from interpolation as any other feature does.
    """
    spark = train.sparkSession
    # Two trainings read these rows many times: they are prepared and drawn once.
    rows = stage_snapshot(balanced(train, resampling, names, key, label), scratch_path(spark, "train"), "function")
    report, _ = gbt_train_cv(rows, names, label, group, k, params)
    path = scratch_path(spark, "model")
    model = gbt_train_full(rows, names, label, params, path)
    predictions = gbt_predict(path, test, key)
    target = submission(template, predictions, key, label, "score", scratch_path(spark, "submission"))
    return report, feature_importance(model, names), target
