"""Which features keep their meaning from one period to the next?"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..columns import Roles
from ..operators.models import feature_time_consistency
from ..operators.prepare import impute_mean
from ..operators.ranks import dense_rank_year_month
from ..operators.relational import drop_cols_null_pct


def consistent_features(df: DataFrame, key: str, label: str, ts: str, k: int = 4, params: dict | None = None) -> DataFrame:
    """(feature, auc, flagged) of every numeric column that is mostly present."""
    pruned = drop_cols_null_pct(df, 50.0)
    numeric = list(Roles.of(pruned, key, label).numeric)
    ranked = dense_rank_year_month(impute_mean(pruned, numeric), ts)
    return feature_time_consistency(ranked, numeric, label, "month_rank", k, params)
