"""From two raw tables to a feature table that is free of missing values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..columns import Roles, col
from ..operators.prepare import (
    FrequentValues,
    LabelCodes,
    drop_high_corr,
    feature_cross,
    fill_null_token,
    fit_frequent,
    fit_label_codes,
    high_corr_drop_list,
    impute_mean,
    skew_log_transform,
    time_month_index,
    zscore,
)
from ..operators.profile import corr_pairs, null_profile
from ..operators.relational import drop_cols_null_pct, join_left
from ..session import scratch_path
from ..sources import stage_snapshot

# Fewest rows a category needs to stay, by column of the card-payment table.
RARE_CARD_CATEGORIES = {
    "card1": 100, "card2": 50, "card3": 20, "card5": 20, "addr1": 30, "id_31": 10, "DeviceInfo": 100,
}


@dataclass(frozen=True)
class Preparation:
    """Settings of the flow. Crosses may use the name of an earlier cross."""

    key: str
    label: str
    seconds: str
    start: str = "2017-11-30"
    base_year: int = 2017
    null_pct: float = 50.0
    max_corr: float = 0.8
    rare: dict[str, int] = field(default_factory=dict)
    crosses: Sequence[tuple[str, str]] = ()
    unskew: bool = False
    standardize: bool = False

    def prepare(self, transactions: DataFrame, identity: DataFrame) -> DataFrame:
        """Fit on two raw tables and return the prepared rows of the same tables."""
        return self.fit(transactions, identity).train

    def fit(self, transactions: DataFrame, identity: DataFrame) -> FittedPreparation:
        """Join, prune, impute, encode. Every fit is one aggregate over a stored stage, so that
        the join runs once and each fit reads only its own columns."""
        joined = drop_cols_null_pct(join_left(transactions, identity, self.key), self.null_pct)
        spark = joined.sparkSession
        table = stage_snapshot(joined, scratch_path(spark, "joined"), "function")

        numeric = list(Roles.of(table, self.key, self.label).numeric)
        doomed = high_corr_drop_list(corr_pairs(table, numeric), null_profile(table.drop(self.label)), self.max_corr)
        table = drop_high_corr(table, [r["column_name"] for r in doomed.collect()])

        roles = Roles.of(table, self.key, self.label)
        text = [*roles.categorical, *[f"{a}_{b}" for a, b in self.crosses]]
        rows = self._named(table, roles)
        frequent = fit_frequent(rows, {n: t for n, t in self.rare.items() if n in roles.categorical})
        rows = self._crossed(frequent.transform(rows))
        means = impute_mean(rows, roles.numeric)
        return FittedPreparation(self, tuple(table.columns), roles, frequent, rows, fit_label_codes(means, text))

    def _named(self, table: DataFrame, roles: Roles) -> DataFrame:
        return fill_null_token(time_month_index(table, self.seconds, self.start, base_year=self.base_year), list(roles.categorical))

    def _crossed(self, rows: DataFrame) -> DataFrame:
        for a, b in self.crosses:
            rows = feature_cross(rows, a, b)
        return rows


@dataclass(frozen=True)
class FittedPreparation:
    """What was learned from one pair of tables, to be applied to it and to others."""

    settings: Preparation
    columns: tuple[str, ...]
    roles: Roles
    frequent: FrequentValues
    seen: DataFrame
    codes: LabelCodes

    @property
    def train(self) -> DataFrame:
        """The prepared rows of the fit."""
        return self._finish(self.seen)

    def transform(self, transactions: DataFrame, identity: DataFrame) -> DataFrame:
        """Prepare other tables in the same way, with or without the label: the columns kept in the fit, its frequent
        categories, means and codes. A category that the fit has not seen counts as rare, or has no code."""
        joined = join_left(transactions, identity, self.settings.key)
        table = joined.select(*[col(c) for c in self.columns if c in joined.columns])
        return self._finish(self.settings._crossed(self.frequent.transform(self.settings._named(table, self.roles))))

    def _finish(self, rows: DataFrame) -> DataFrame:
        s, numeric = self.settings, list(self.roles.numeric)
        out, seen = impute_mean(rows, numeric, fit_on=self.seen), impute_mean(self.seen, numeric)
        if s.unskew:
            names = [n for n in numeric if n != s.seconds]
            out, seen = skew_log_transform(out, names, fit_on=seen), skew_log_transform(seen, names)
        if s.standardize:
            out = zscore(out, numeric, fit_on=seen)
        return self.codes.transform(out)
