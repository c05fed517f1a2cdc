"""Cleaning, encoding and feature engineering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, melt, require
from ..functions import fn_as_string, fn_concat_key, fn_log10_shift, fn_month_index, fn_start_plus_seconds
from ..ordering import attach, column_parts, ordered_index
from ..session import pin
from .chained import impute_chained
from .profile import _wide, skew_profile

# ---- filling missing values -----------------------------------------------------------


def fill_constant(df: DataFrame, names: Sequence[str], value=-1) -> DataFrame:
    """Missing values become the constant, in the column's own type."""
    require(df, names)
    return df.withColumns({n: F.coalesce(col(n), F.lit(value).cast(df.schema[n].dataType)) for n in names})


def fill_null_token(df: DataFrame, names: Sequence[str], token: str = "nullstr") -> DataFrame:
    return df.withColumns({n: F.coalesce(col(n).cast("string"), F.lit(token)) for n in names})


@dataclass(frozen=True)
class FilledColumns:
    """One replacement value per column."""

    values: dict[str, object]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            n: F.coalesce(col(n), F.lit(v).cast(df.schema[n].dataType)) for n, v in self.values.items() if n in df.columns})


def fit_mean(df: DataFrame, names: Sequence[str]) -> FilledColumns:
    row = _wide(df, names, {"m": F.avg}).first() if names else None
    return FilledColumns({n: row[f"{n}|m"] for n in names})


def impute_mean(df: DataFrame, names: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill each numeric column with its mean (as double), fitted here or on another table."""
    cast = {n: col(n).cast("double") for n in names}
    return fit_mean(df if fit_on is None else fit_on, names).transform(df.withColumns(cast))


def fit_mode(df: DataFrame, names: Sequence[str]) -> FilledColumns:
    """Most frequent value per column, on ties the smallest in the column's own order; all columns in one job."""
    if not names:
        return FilledColumns({})
    counts = melt(df, names, as_type="string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    numbers = [n for n in names if isinstance(df.schema[n].dataType, T.NumericType)]
    rank = F.when(F.col("column_name").isin(numbers), F.expr("try_cast(value AS double)"))
    best = counts.groupBy("column_name").agg(F.min(F.struct((-F.col("c")).alias("c"), rank.alias("rank"), "value")).alias("b"))
    found = {r["column_name"]: r["b"]["value"] for r in best.collect()}
    return FilledColumns({n: found.get(n) for n in names})


def impute_mode(df: DataFrame, names: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fit_mode(df if fit_on is None else fit_on, names).transform(df)


# ---- categories -----------------------------------------------------------------------


@dataclass(frozen=True)
class FrequentValues:
    """(column_name, value) of the categories that are kept; the others become one."""

    names: tuple[str, ...]
    kept: DataFrame | None
    other: str = "others"

    def transform(self, df: DataFrame) -> DataFrame:
        """Missing values stay, a value that was not seen in the fit is a rare one."""
        if not self.names:
            return df
        out = df.withColumns({n: col(n).cast("string") for n in self.names})
        for n, kept in column_parts(self.kept.withColumn("_kept", F.lit(True)), list(self.names)).items():
            out = attach(out, kept, n, null_safe=False).withColumn(
                n, F.when(col(n).isNull() | F.col("_kept"), col(n)).otherwise(F.lit(self.other))).drop("_kept")
        return out


def fit_frequent(df: DataFrame, thresholds: dict[str, int], other: str = "others") -> FrequentValues:
    """Values seen at least as often as the column's threshold; all columns in one job."""
    names = list(thresholds)
    if not names:
        return FrequentValues((), None, other)
    limit = F.lit(None).cast("long")
    for n, t in thresholds.items():
        limit = F.when(F.col("column_name") == n, F.lit(t)).otherwise(limit)
    counts = melt(df, names, as_type="string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    return FrequentValues(tuple(names), pin(counts.filter(F.col("c") >= limit).select("column_name", "value")), other)


def rare_to_others(df: DataFrame, thresholds: dict[str, int], other: str = "others", fit_on: DataFrame | None = None) -> DataFrame:
    """Values seen fewer than the column's threshold become one category; missing ones stay."""
    return fit_frequent(df if fit_on is None else fit_on, thresholds, other).transform(df)


def feature_cross(df: DataFrame, a: str, b: str) -> DataFrame:
    """Add the column a_b holding 'a_b', missing parts as text."""
    return df.withColumn(f"{a}_{b}", fn_concat_key(col(a), col(b)))


@dataclass(frozen=True)
class LabelCodes:
    """(column_name, value, code) of every encoded column."""

    names: tuple[str, ...]
    codes: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the columns by their codes; a value not seen in the fit becomes NULL."""
        if not self.names:
            return df
        out = df.withColumns({n: fn_as_string(col(n)) for n in self.names})
        for n, own in column_parts(self.codes.withColumnRenamed("code", "_c"), self.names).items():
            out = attach(out, own, n, null_safe=False).withColumn(n, F.col("_c")).drop("_c")
        return out.select(*[col(n) for n in df.columns])


def fit_label_codes(df: DataFrame, names: Sequence[str]) -> LabelCodes:
    """Code = position of the text among the column's sorted distinct texts. All columns share
    one distinct and one range sort, so that a high-cardinality column is no single task."""
    if not names:
        return LabelCodes((), df.sparkSession.createDataFrame([], "column_name string, value string, code int"))
    texts = df.select(*[fn_as_string(col(n)).alias(n) for n in names])
    distinct = melt(texts, names, as_type="string").distinct()
    return LabelCodes(tuple(names), pin(ordered_index(distinct, ["value"], "column_name", "code")))


def label_encode(df: DataFrame, names: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return fit_label_codes(df if fit_on is None else fit_on, names).transform(df)


# ---- numeric features -----------------------------------------------------------------


def time_month_index(df: DataFrame, seconds: str, start: str = "2017-11-30", name: str = "DT_M", base_year: int = 2017) -> DataFrame:
    """Month number of a seconds offset from a start date."""
    return df.withColumn(name, fn_month_index(fn_start_plus_seconds(col(seconds), start), base_year))


def zscore(df: DataFrame, names: Sequence[str], eps: float = 1e-6, fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / (std + eps) for the named columns; the others (key, label, group) stay."""
    if not names:
        return df
    row = _wide(df if fit_on is None else fit_on, names, {"m": F.avg, "s": F.stddev_samp}).first()
    return df.withColumns({
        n: (col(n).cast("double") - F.lit(row[f"{n}|m"])) / (F.lit(row[f"{n}|s"]) + F.lit(eps)) for n in names})


def skew_log_transform(df: DataFrame, names: Sequence[str], above: float = 1.0, fit_on: DataFrame | None = None) -> DataFrame:
    """Shifted log10 of the columns whose skewness is above the limit."""
    if not names:
        return df
    seen = df if fit_on is None else fit_on
    skews = {r["column_name"]: r["skew"] for r in skew_profile(seen, names).collect()}
    skewed = [n for n in names if skews[n] is not None and skews[n] > above]
    if not skewed:
        return df
    low = _wide(seen, skewed, {"m": F.min}).first()
    return df.withColumns({n: fn_log10_shift(col(n).cast("double"), low[f"{n}|m"]) for n in skewed})


# The open ranges of the integer types and of the single-precision float.
_INTEGER_TYPES = [("tinyint", 1, 8), ("smallint", 2, 16), ("int", 4, 32), ("bigint", 8, 64)]
_FLOAT_LIMIT = 3.4028234663852886e38


def narrow_types(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each numeric column in the smallest type whose range strictly contains its values."""
    row = df.agg(*[f(col(n)).alias(f"{n}|{s}") for n in names for s, f in (("lo", F.min), ("hi", F.max))]).first()
    casts = {}
    for n in names:
        lo, hi, kind = row[f"{n}|lo"], row[f"{n}|hi"], df.schema[n].dataType
        if lo is None:
            continue
        if isinstance(kind, T.IntegralType):
            casts[n] = next((name for name, _, bits in _INTEGER_TYPES
                             if -(2 ** (bits - 1)) < lo and hi < 2 ** (bits - 1) - 1), "bigint")
        elif isinstance(kind, T.DoubleType) and -_FLOAT_LIMIT < lo and hi < _FLOAT_LIMIT:
            casts[n] = "float"
    return df.withColumns({n: col(n).cast(t) for n, t in casts.items()})


_WIDTHS = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}


def narrow_types_report(df: DataFrame, narrowed: DataFrame) -> DataFrame:
    """(bytes_before, bytes_after, saved_percent) of the numeric columns."""
    def width(frame: DataFrame) -> int:
        return sum(_WIDTHS.get(f.dataType.simpleString(), 0) for f in frame.schema.fields)

    before, after = width(df), width(narrowed.select(*[col(n) for n in df.columns]))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        (F.col("rows") * before).alias("bytes_before"), (F.col("rows") * after).alias("bytes_after"),
        F.lit(100.0 * (before - after) / before if before else 0.0).alias("saved_percent"))


# ---- correlated columns ---------------------------------------------------------------


def high_corr_drop_list(pairs: DataFrame, null_profile: DataFrame, r: float = 0.8) -> DataFrame:
    """(position, column_name): of each strongly correlated pair the column with more missing
    values, the second one on ties; each column once, in pair order. Rows are column pairs."""
    share = null_profile.select("column_name", F.col("nan_percent"))
    strong = pairs.filter(F.col("abs_r") >= r)
    for side in ("a", "b"):
        strong = strong.join(share.toDF(f"column_{side}", f"nan_{side}"), f"column_{side}", "left").fillna(0.0, [f"nan_{side}"])
    place = F.row_number().over(Window.orderBy(F.desc("abs_r"), "column_a", "column_b"))
    victim = F.when(F.col("nan_a") > F.col("nan_b"), F.col("column_a")).otherwise(F.col("column_b"))
    first = strong.select(place.alias("place"), victim.alias("column_name")).groupBy("column_name").agg(F.min("place").alias("place"))
    return first.select(F.row_number().over(Window.orderBy("place")).alias("position"), "column_name")


def drop_high_corr(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove the listed columns that are present."""
    return df.drop(*[n for n in names if n in df.columns])
