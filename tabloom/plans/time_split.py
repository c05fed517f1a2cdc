"""How well does a booster foresee later rows when it may only learn from earlier ones?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..columns import Roles
from ..operators.models import gbt_train_time_cv
from ..operators.prepare import fill_constant, impute_mean, label_encode
from ..operators.ranks import dense_rank_date
from ..operators.relational import drop_cols_null_pct
from ..session import scratch_path
from ..sources import stage_snapshot


def evaluate_over_time(df: DataFrame, key: str, label: str, ts: str, order: Sequence[str], k: int = 5,
                       params: dict | None = None) -> DataFrame:
    """(fold, auc): prune, fill, rank the days, encode, then train on an expanding window."""
    pruned = drop_cols_null_pct(df, 50.0)
    roles = Roles.of(pruned, key, label)
    numeric = [n for n in roles.numeric if n not in order]
    text = list(roles.categorical)
    filled = impute_mean(fill_constant(pruned, text), numeric)
    encoded = label_encode(dense_rank_date(filled, ts), text)
    # Folds read the prepared rows many times: prepare them once.
    stored = stage_snapshot(encoded, scratch_path(df.sparkSession, "prepared"), "function")
    return gbt_train_time_cv(stored, [*numeric, *text, "day_rank"], label, order, k, params)
