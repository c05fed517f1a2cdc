"""Profiles and aggregates over columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col, listed, melt, one_row_to_long
from ..ordering import attach, class_aggregates, classed_columns, quantile_table
from ..session import driver_table, pin
from .correlate import pairwise_correlations

# ---- missing values -------------------------------------------------------------------


def _nulls(df: DataFrame) -> DataFrame:
    """One row: every column's null count, in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(n).isNull()).alias(f"{n}|null_count") for n in df.columns])


def null_counts(df: DataFrame) -> tuple[int, dict[str, int]]:
    row = _nulls(df).first()
    return row["_rows"], {n: row[f"{n}|null_count"] for n in df.columns}


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count, nan_percent)."""
    items = [
        F.struct(F.lit(n).alias("column_name"), col(f"{n}|null_count").alias("null_count"), F.col("_rows").alias("rows"))
        for n in df.columns]
    return _nulls(df).select(F.inline(F.array(*items))).select(
        "column_name", "null_count",
        F.when(F.col("rows") > 0, F.col("null_count") * 100.0 / F.col("rows")).alias("nan_percent"))


def row_null_counts(df: DataFrame, key: str) -> DataFrame:
    """Missing values per row, as a number and as a share of the other columns."""
    others = [n for n in df.columns if n != key]
    nulls = sum([col(n).isNull().cast("int") for n in others], F.lit(0))
    return df.select(
        col(key), nulls.alias("null_count"), (nulls * (100.0 / max(len(others), 1))).alias("null_percent"))


def null_pct_shift_after_join(before: DataFrame, after: DataFrame, names: Sequence[str]) -> DataFrame:
    """Null share of the same columns in two tables, and the difference."""
    a = null_profile(before.select(*[col(n) for n in names])).select("column_name", F.col("nan_percent").alias("before"))
    b = null_profile(after.select(*[col(n) for n in names])).select("column_name", F.col("nan_percent").alias("after"))
    return a.join(b, "column_name").withColumn("shift", F.col("after") - F.col("before"))


def null_total_assert(df: DataFrame, raise_on_nonzero: bool = True) -> DataFrame:
    """Total number of missing values; raises when there are any and that was asked for."""
    total = null_profile(df).agg(F.sum("null_count").alias("null_total"))
    if raise_on_nonzero and (left := total.first()[0]):
        raise ValueError(f"{left} missing values remain")
    return total


# ---- frequencies ----------------------------------------------------------------------


def value_counts(df: DataFrame, name: str) -> DataFrame:
    return (
        df.filter(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), col(name)))


def value_counts_normalized(df: DataFrame, name: str, by: str) -> DataFrame:
    """Relative frequency of each value within each class."""
    counts = (
        df.filter(col(name).isNotNull()).groupBy(col(by), col(name)).agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy(col(by)).agg(F.sum("count").alias("_total"))
    return (
        attach(counts, pin(totals), by)
        .withColumn("frequency", F.col("count") / F.col("_total")).drop("_total"))


def count_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, twice, ..."""
    return (
        df.groupBy(col(key)).agg(F.count(F.lit(1)).alias("occurrences"))
        .groupBy("occurrences").agg(F.count(F.lit(1)).alias("keys")))


def row_counts(**frames: DataFrame) -> DataFrame:
    parts = [f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def mode_value(df: DataFrame, name: str) -> DataFrame:
    """Most frequent value; the smallest one on ties."""
    return value_counts(df, name).limit(1)


def distinct_count(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct values per column, through one aggregate over (column, value) pairs."""
    long = melt(df, names, as_type="string").distinct()
    found = long.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    all_names = driver_table(df.sparkSession, [(n,) for n in names], "column_name string")
    return all_names.join(found, "column_name", "left").select(
        "column_name", F.coalesce("n", F.lit(0)).alias("distinct_values"))


def count_per_time_bucket(df: DataFrame, ts: str, every: str = "1 day") -> DataFrame:
    """Rows per time bucket that holds any; works on a streaming frame as well. Months, quarters and years are those
    of the calendar: '1 month', '1 quarter', '1 year', or a number of them counted from the year 0."""
    number, unit = (every.split() + ["day"])[:2] if every.split()[0].isdigit() else ("1", every)
    months = {"month": 1, "quarter": 3, "year": 12}.get(unit.rstrip("s").lower())
    if months:
        width = int(number) * months
        place = F.year(col(ts)) * 12 + F.month(col(ts)) - 1
        first = place - F.pmod(place, F.lit(width))
        start = F.make_timestamp(F.floor(first / 12).cast("int"), (F.pmod(first, F.lit(12)) + 1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        return df.filter(col(ts).isNotNull()).groupBy(start.alias("bucket_start")).agg(F.count(F.lit(1)).alias("rows"))
    return (
        df.groupBy(F.window(col(ts), every)).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.col("window.start").alias("bucket_start"), "rows"))


def count_by_year(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.year(col(ts)).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


# ---- moments and quantiles ------------------------------------------------------------


def _wide(df: DataFrame, names: Sequence[str], stats: dict[str, callable]) -> DataFrame:
    return df.agg(*[f(col(n).cast("double")).alias(f"{n}|{s}") for n in names for s, f in stats.items()])


def column_mean_std(df: DataFrame, names: Sequence[str]) -> DataFrame:
    stats = {"mean": F.avg, "std": F.stddev_samp}
    return one_row_to_long(_wide(df, names, stats), names, list(stats))


def column_min_max(df: DataFrame, names: Sequence[str]) -> DataFrame:
    stats = {"min": F.min, "max": F.max}
    return one_row_to_long(_wide(df, names, stats), names, list(stats))


def unbiased_skew(n: Column, population_skew: Column) -> Column:
    return F.when(n > 2, population_skew * F.sqrt(n * (n - 1)) / (n - 2))


def skew_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Bias-corrected skewness per column; missing below three values."""
    stats = {"n": F.count, "g": F.skewness}
    return one_row_to_long(_wide(df, names, stats), names, list(stats)).select(
        "column_name", unbiased_skew(F.col("n"), F.col("g")).alias("skew"))


_MOMENTS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def describe(df: DataFrame, names: Sequence[str], by: str | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max per column (and class); a column without values has count 0 and NULL elsewhere."""
    table = quantile_table(df, names, [0.25, 0.5, 0.75], by, _MOMENTS, ["q25", "q50", "q75"])
    return table.select(*listed(by), "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_by_class(df: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    """Long form (label, column_name, statistic, value) without count and max."""
    wide = describe(df, names, label)
    return wide.select(col(label), "column_name", "mean", "std", "min", "q25", "q50", "q75").unpivot(
        [col(label), F.col("column_name")], ["mean", "std", "min", "q25", "q50", "q75"], "statistic", "value")


def quantiles(df: DataFrame, name: str, qs: Sequence[float]) -> DataFrame:
    """(q, value) of one column, linearly interpolated, exact."""
    labels = [f"q{i}" for i in range(len(qs))]
    table = quantile_table(df, [name], qs, names=labels)
    items = F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(a).alias("value")) for q, a in zip(qs, labels)])
    return table.select(F.inline(items))


def box_stats(df: DataFrame, name: str, by: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and number of outliers per class."""
    quart = pin(quantile_table(df, [name], [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"])).drop("column_name")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    joined = attach(df.select(col(by), col(name).cast("double").alias("v")).filter("v is not null"), quart, by)
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(col(by), "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


# ---- histograms -----------------------------------------------------------------------


def histograms(df: DataFrame, names: Sequence[str], bins: int = 10, by: str | None = None) -> DataFrame:
    """Equal-width bins between each column's (and class's) minimum and maximum, the last one
    closed, empty ones included: (by, column_name, bin, bin_low, bin_high, count).

    One aggregate finds the ends, one pass counts all columns side by side. Many classes are joined with their ends.
    """
    found = class_aggregates(df, names, by, {"lo": F.min, "hi": F.max})
    if found is None:
        return _joined_histograms(df, names, bins, by)
    classes, ends = found
    spans = {}
    for i, c in enumerate(classes):
        for j in range(len(names)):
            lo, hi = ends[c, j]["lo"], ends[c, j]["hi"]
            if lo is not None:
                # A constant column gets the unit interval around its value.
                spans[i, j] = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
    counts = {(r["class"], r["column"], r["bin"]): r["c"] for r in _bin_counts(classed_columns(df, names, by, classes), spans, bins).collect()}
    rows = []
    for (i, j), (lo, hi) in spans.items():
        width = (hi - lo) / bins
        rows += [(*([classes[i]] if by else []), names[j], b, lo + b * width, lo + (b + 1) * width, counts.get((i, j, b), 0)) for b in range(bins)]
    kinds = [T.StructField("column_name", T.StringType()), T.StructField("bin", T.IntegerType()), T.StructField("bin_low", T.DoubleType()),
             T.StructField("bin_high", T.DoubleType()), T.StructField("count", T.LongType())]
    return df.sparkSession.createDataFrame(rows, T.StructType(([T.StructField(by, df.schema[by].dataType)] if by else []) + kinds))


def _bin_counts(facts: DataFrame, spans: dict[tuple[int, int], tuple[float, float]], bins: int) -> DataFrame:
    """(class, column, bin, c): a task counts all its rows before anything is shuffled."""
    import numpy as np
    import pyarrow as pa

    def scan(batches):
        total = {at: np.zeros(bins, dtype=np.int64) for at in spans}
        for batch in batches:
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            columns = [batch.column(j + 1).to_numpy(zero_copy_only=False).astype(float) for j in range(batch.num_columns - 1)]
            for (i, j), (lo, hi) in spans.items():
                values = columns[j][(classes == i) & ~np.isnan(columns[j])]
                place = np.floor((values - lo) / ((hi - lo) / bins)).astype(np.int64)
                total[i, j] += np.bincount(np.minimum(place, bins - 1), minlength=bins)
        rows = [(i, j, b, int(c)) for (i, j), t in total.items() for b, c in enumerate(t) if c]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate([pa.int32()] * 3 + [pa.int64()])],
                                         ["class", "column", "bin", "c"])

    return facts.mapInArrow(scan, "class int, column int, bin int, c long").groupBy("class", "column", "bin").agg(F.sum("c").alias("c"))


def _joined_histograms(df: DataFrame, names: Sequence[str], bins: int, by: str) -> DataFrame:
    """histograms for many classes: every value is joined with the ends of its class and column."""
    keys = listed(by) + ["column_name"]
    facts = melt(df, names, listed(by)).filter(~F.isnan("value"))
    spans = facts.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # A constant column gets the unit interval around its value.
    flat = F.col("lo") == F.col("hi")
    spans = pin(spans.withColumns({
        "lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))}))
    place = F.floor((F.col("value") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins))
    counted = pin(
        attach(facts, spans, keys, "inner")
        .groupBy(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count")))
    grid = spans.select(*keys, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return attach(grid, counted, [*keys, "bin"]).select(
        *keys, "bin", (F.col("lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("count", F.lit(0)).alias("count"))


def histogram(df: DataFrame, name: str, bins: int = 10, by: str | None = None) -> DataFrame:
    return histograms(df, [name], bins, by).drop("column_name")


def minmax_heights(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bin counts rescaled to [0, 1] per histogram; missing when the histogram is flat."""
    w = Window.partitionBy(*keys)
    low, high = F.min("count").over(w), F.max("count").over(w)
    return hist.withColumn("height", F.when(high > low, (F.col("count") - low) / (high - low)))


def histogram_minmax(df: DataFrame, name: str, bins: int = 10, by: str | None = None) -> DataFrame:
    keys = listed(by) + ["column_name"]
    return minmax_heights(histograms(df, [name], bins, by), keys).drop("column_name")


# ---- correlation ----------------------------------------------------------------------

def corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (column_a, column_b, r), both triangles and the diagonal."""
    upper = pairwise_correlations(df, names)
    lower = F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "r")
    both = upper.select(F.inline(F.array(F.struct("column_a", "column_b", "r"), lower)))
    diagonal = column_mean_std(df, names).select(
        F.col("column_name").alias("column_a"), F.col("column_name").alias("column_b"),
        F.when(F.col("std") > 0, F.lit(1.0)).alias("r"))
    return both.unionByName(diagonal)


def corr_pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Absolute correlation of every unordered pair (column_a < column_b), strongest first."""
    return pairwise_correlations(df, names).select("column_a", "column_b", F.abs("r").alias("abs_r")).orderBy(
        F.desc_nulls_last("abs_r"), "column_a", "column_b")
