"""Projections, filters, joins, set operations, sorts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, listed, melt, require
from ..ordering import attach, quantile_values
from ..session import driver_table, pin
from .profile import null_counts

# ---- projections ----------------------------------------------------------------------


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[col(n) for n in names])


def drop_columns(df: DataFrame, names: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop columns; strict raises when one is absent, tolerant ignores it."""
    if strict:
        require(df, names)
    return df.drop(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_pattern(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace a token in every column name."""
    return df.withColumnsRenamed({n: n.replace(old, new) for n in df.columns if old in n})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast; a value that does not fit becomes NULL."""
    require(df, types)
    return df.withColumns({n: col(n).try_cast(t) for n, t in types.items()})


def split_by_dtype(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(numeric, categorical) frames by column type, the key kept in both."""
    numeric = [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields
            if f.name != key and isinstance(f.dataType, (T.StringType, T.BooleanType))]
    return select_columns(df, [key, *numeric]), select_columns(df, [key, *text])


def pop_label(df: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(features, (key, label))."""
    require(df, [key, label])
    return df.drop(label), select_columns(df, [key, label])


# ---- filters --------------------------------------------------------------------------


def filter_equals(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(col(name) == F.lit(value))


def filter_in(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    return df.filter(col(name).isin(list(values)))


def filter_is_null(df: DataFrame, name: str) -> DataFrame:
    return df.filter(col(name).isNull())


def filter_range_quantile(df: DataFrame, name: str, lo: float = 0.003, hi: float = 0.997) -> DataFrame:
    """Rows between two quantiles of the whole column; the bounds are literals, so the filter
    is pushed down to the scan."""
    found = quantile_values(df, [name], [lo, hi]).get(name)
    return df.filter(col(name).between(*found)) if found else df.filter(F.lit(False))


def drop_null_rows(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(names)) if names else df.na.drop()


def recode_values(df: DataFrame, name: str, mapping: dict) -> DataFrame:
    """Map values to new ones; others, and missing ones, stay."""
    return df.replace({k: v for k, v in mapping.items()}, subset=[name])


def drop_cols_null_pct(df: DataFrame, pct: float = 50.0) -> DataFrame:
    """Drop the columns whose share of missing values is above pct percent."""
    rows, nulls = null_counts(df)
    return df.drop(*[n for n, c in nulls.items() if rows and 100.0 * c / rows > pct])


def drop_cols_null_count(df: DataFrame, max_nulls: int = 10) -> DataFrame:
    """Keep the columns with fewer than max_nulls missing values, then the complete rows."""
    _, nulls = null_counts(df)
    return df.select(*[col(n) for n in df.columns if nulls[n] < max_nulls]).na.drop()


def low_cardinality_columns(df: DataFrame, names: Sequence[str], below: int = 3) -> DataFrame:
    """(column_name, distinct_values, values) of columns with fewer than `below` values; one without any has 0 and an empty text.

    A sketch of all columns side by side leaves out those that have many more; only the others are looked at value by value.
    """
    require(df, names)
    guess = df.agg(*[F.approx_count_distinct(col(n).cast("string")).alias(f"c{i}") for i, n in enumerate(names)]).first()
    likely = [n for n, g in zip(names, guess) if g <= 2 * below + 8]
    spark = df.sparkSession
    grid = driver_table(spark, [(n,) for n in likely], "column_name string")
    if not likely:
        return grid.selectExpr("column_name", "0L AS distinct_values", "'' AS values")
    found = pin(melt(df, likely, as_type="string").distinct()).groupBy("column_name").agg(F.array_sort(F.collect_list("value")).alias("v"))
    known = F.coalesce("v", F.array().cast("array<string>"))
    return grid.join(found, "column_name", "left").select(
        "column_name", F.size(known).cast("long").alias("distinct_values"), F.array_join(known, ",").alias("values")).filter(
        F.col("distinct_values") < below)


# ---- joins ----------------------------------------------------------------------------


def join_left(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return a.join(b, listed(key), "left")


def join_right(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return a.join(b, listed(key), "right")


def join_outer(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Full outer join, as a left join plus the right rows without a partner: a hot key can be
    split in either of these, but not in a full outer join."""
    keys = listed(key)
    alone = b.join(a.select(*[col(k) for k in keys]), keys, "left_anti")
    return a.join(b, keys, "left").unionByName(alone, allowMissingColumns=True)


def join_feature_blocks(numeric: DataFrame, categorical: DataFrame, key: str) -> DataFrame:
    """Put separately prepared blocks of one table back together."""
    return numeric.join(categorical, [key], "left")


def join_label_to_feature(df: DataFrame, feature: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """One feature with the label and group columns of the main table."""
    return feature.join(select_columns(df, [key, *names]), [key], "left")


def join_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Facts with a dimension's attributes; broadcast when the dimension's size allows it."""
    dim = dim.withColumnRenamed(dim_key, fact_key) if dim_key and dim_key != fact_key else dim
    return attach(facts, dim, fact_key)


def join_lookup_map(df: DataFrame, name: str, mapping: DataFrame, value: str, as_name: str) -> DataFrame:
    """Replace a value by its entry in a (name, value) table."""
    return attach(df, mapping.select(col(name), col(value).alias(as_name)), name)


def join_submission(template: DataFrame, predictions: DataFrame, key: str, placeholder: str, score: str) -> DataFrame:
    """The template's rows in key order with the placeholder column replaced by the score."""
    scored = predictions.select(col(key), col(score).alias(placeholder))
    return template.select(col(key)).join(scored, [key], "left").orderBy(col(key).asc_nulls_last())


# ---- sets -----------------------------------------------------------------------------


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: keys in both, only in the left, only in the right table. One shuffle of keys."""
    left = a.select(col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = b.select(col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    sides = left.unionAll(right).filter(F.col("k").isNotNull()).groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return sides.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("in_both"),
        F.count_if(F.col("r") == 0).alias("only_left"),
        F.count_if(F.col("l") == 0).alias("only_right"))


def union_rows(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def concat_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Column-wise concatenation aligned on the key: a key of either side stays."""
    return join_outer(a, b, key)


def _dedup(df: DataFrame, names: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    others = [n for n in df.columns if n not in names]
    ordered = [*order, *[n for n in others if n not in order]]
    pick = F.max if last else F.min
    # An aggregate instead of a window: copies of a hot key combine before the shuffle.
    best = df.groupBy(*[col(n) for n in names]).agg(pick(F.struct(*[col(n) for n in ordered])).alias("_r"))
    return best.select(*[col(n) if n in names else F.col("_r").getField(n).alias(n) for n in df.columns])


def dedup_keep_first(df: DataFrame, names: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Without names: distinct rows. With names: the earliest row per key in the given order."""
    return _dedup(df, names, order, last=False) if names else df.dropDuplicates()


def dedup_keep_last(df: DataFrame, names: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    return _dedup(df, names, order, last=True) if names else df.dropDuplicates()


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct()


def ordered_distinct(df: DataFrame, name: str, position: str) -> DataFrame:
    """Each value once, in the order of its first occurrence."""
    return df.groupBy(col(name)).agg(F.min(col(position)).alias("first_position")).orderBy("first_position")


# ---- sorts ----------------------------------------------------------------------------


def _ordering(names: Sequence[str], ascending: Sequence[bool] | bool) -> list[Column]:
    flags = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    return [col(n).asc_nulls_last() if up else col(n).desc_nulls_last() for n, up in zip(names, flags)]


def sort_by(df: DataFrame, names: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    """Missing values last in either direction."""
    return df.orderBy(*_ordering(names, ascending))


def top_k(df: DataFrame, name: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(*_ordering([name, tie], [False, True])).limit(k)


def bottom_k(df: DataFrame, name: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(*_ordering([name, tie], [True, True])).limit(k)
