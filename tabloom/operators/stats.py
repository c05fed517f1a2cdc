"""Statistical tests and trends."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..columns import col
from ..functions import fn_strip_thousands
from ..ordering import quantile_values
from ..session import pin
from .prepare import label_encode
from .profile import histograms, minmax_heights, value_counts
from .relational import bottom_k, join_dimension, top_k

# ---- tails of the F and t distributions (one number on the driver) ---------------------


def beta_tail(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function I_x(a, b) by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_tail(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for step in range(2000):
        m = step // 2
        if step == 0:
            term = 1.0
        elif step % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + term * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + term / (c if abs(c) > tiny else tiny)
        f *= c * d
        if abs(c * d - 1.0) < 1e-14:
            break
    return front * (f - 1.0)


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    return beta_tail(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f))


def t_tail(t: float, df: float) -> float:
    """Two-sided P(|T| > |t|)."""
    return beta_tail(df / 2.0, 0.5, df / (df + t * t))


# ---- tests ----------------------------------------------------------------------------


def _moments(df: DataFrame, name: str, by: str) -> DataFrame:
    v = col(name).cast("double")
    return (
        df.filter(col(name).isNotNull() & col(by).isNotNull()).groupBy(col(by))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var")))


def anova_oneway(df: DataFrame, name: str, by: str) -> DataFrame:
    """(f, df_between, df_within, p) over all groups; f and p are missing with one group, with one row to a group,
    or without spread within the groups."""
    groups = pin(_moments(df, name, by))
    grand = groups.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("m")).first()["m"]
    if grand is None:
        return groups.agg(*[F.lit(None).cast("double").alias("f"), (F.count(F.lit(1)) - 1).alias("df_between"),
                            (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("df_within"), F.lit(None).cast("double").alias("p")])
    sums = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.lit(grand), 2)).alias("between"),
        F.sum((F.col("n") - 1) * F.coalesce("var", F.lit(0.0))).alias("within"),
        (F.count(F.lit(1)) - 1).alias("df_between"), (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
    ).select(
        F.when((F.col("df_between") > 0) & (F.col("df_within") > 0) & (F.col("within") > 0),
               F.try_divide(F.try_divide(F.col("between"), F.col("df_between")), F.try_divide(F.col("within"), F.col("df_within")))).alias("f"),
        "df_between", "df_within")
    row = sums.first()
    p = f_tail(row["f"], row["df_between"], row["df_within"]) if row["f"] is not None else None
    return sums.withColumn("p", F.lit(p).cast("double"))


def ttest_independent(df: DataFrame, name: str, by: str, g1, g2) -> DataFrame:
    """(t, df, p) of two groups with pooled variance; t and p are missing without spread or with a group missing."""
    two = _moments(df.filter(col(by).isin([g1, g2])), name, by)

    def of(group, what: str) -> Column:
        return F.max(F.when(col(by) == F.lit(group), F.col(what)))

    row = two.agg(*[of(g, w).alias(f"{w}{i}") for i, g in ((1, g1), (2, g2)) for w in ("n", "mean", "var")])
    dof = F.col("n1") + F.col("n2") - 2
    pooled = F.try_divide((F.col("n1") - 1) * F.coalesce("var1", F.lit(0.0)) + (F.col("n2") - 1) * F.coalesce("var2", F.lit(0.0)), dof)
    t = F.try_divide(F.col("mean1") - F.col("mean2"), F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2"))))
    out = pin(row.select(t.alias("t"), dof.alias("df")))
    found = out.first()
    p = t_tail(found["t"], found["df"]) if found["t"] is not None else None
    return out.withColumn("p", F.lit(p).cast("double"))


# Exact two-sample Kolmogorov-Smirnov p by 10 * D for two samples of ten.
KS_TEN_BY_TEN = {
    0: 1.0, 1: 1.0, 2: 0.99445755, 3: 0.78692979, 4: 0.41752365, 5: 0.16782134,
    6: 0.05244755, 7: 0.0123406006, 8: 0.00205676676, 9: 0.000216501764, 10: 0.0000108250882,
}
KS_BINS = 10


def _ks_on_heights(df: DataFrame, names: Sequence[str], label: str, alpha: float) -> DataFrame:
    """Two-sample KS on the ten rescaled bin heights per class: (column_name, d, p, differs)."""
    classed = df.filter(col(label).isin(0, 1))
    hist = minmax_heights(histograms(classed, names, KS_BINS, label), [label, "column_name"])
    # At most 20 heights per column from here on.
    w = Window.partitionBy("column_name").orderBy("height").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    flat = F.max(F.col("height").isNull()).over(Window.partitionBy("column_name"))
    steps = hist.select(
        "column_name", flat.alias("flat"),
        F.abs(F.sum(F.when(col(label) == 1, 1).otherwise(-1)).over(w)).alias("gap"))
    gaps = steps.groupBy("column_name").agg(F.max("gap").alias("gap"), F.max("flat").alias("flat"))
    table = F.create_map(*[F.lit(x) for pair in KS_TEN_BY_TEN.items() for x in pair])
    gap = F.when(~F.col("flat"), F.col("gap").cast("int"))
    return gaps.select(
        "column_name", (gap / 10.0).alias("d"), F.element_at(table, gap).alias("p"),
    ).withColumn("differs", F.col("p") < alpha)


def ks_histogram_numeric(df: DataFrame, names: Sequence[str], label: str, alpha: float = 0.05,
                         lo: float = 0.003, hi: float = 0.997) -> DataFrame:
    """Values outside the whole column's quantile range are left out; label is 0 or 1."""
    bounds = {n: b for n, b in quantile_values(df, names, [lo, hi]).items() if b[0] is not None}
    trimmed = df.select(col(label), *[
        F.when(col(n).cast("double").between(*bounds[n]), col(n).cast("double")).alias(n) for n in names if n in bounds])
    return _ks_on_heights(trimmed, [n for n in names if n in bounds], label, alpha)


def ks_histogram_categorical(df: DataFrame, names: Sequence[str], label: str, alpha: float = 0.05) -> DataFrame:
    """The same over label codes, untrimmed."""
    encoded = label_encode(df.select(col(label), *[col(n) for n in names]), list(names))
    return _ks_on_heights(encoded, names, label, alpha)


# ---- trends ---------------------------------------------------------------------------


def _line(period_cols: Sequence[str]) -> dict[str, Column]:
    """Least-squares line over x = 0, 1, ... of one row's columns, as plain arithmetic: the
    series of an entity is one wide row, so that nothing is shuffled. Missing values are skipped."""
    ys = [fn_strip_thousands(col(c).cast("string")) for c in period_cols]
    there = [y.isNotNull().cast("double") for y in ys]
    y0 = [F.coalesce(y, F.lit(0.0)) for y in ys]
    n = sum(there, F.lit(0.0))
    sx = sum([t * float(i) for i, t in enumerate(there)], F.lit(0.0))
    sxx = sum([t * float(i * i) for i, t in enumerate(there)], F.lit(0.0))
    sy = sum(y0, F.lit(0.0))
    sxy = sum([y * float(i) for i, y in enumerate(y0)], F.lit(0.0))
    spread = n * sxx - sx * sx
    slope = F.when(spread > 0, (n * sxy - sx * sy) / spread)
    return {"n": n, "sx": sx, "slope": slope, "intercept": (sy - slope * sx) / n}


def trend_slope(wide: DataFrame, key: str, period_cols: Sequence[str]) -> DataFrame:
    """(key, slope) of each row's series; period_cols run from the oldest to the newest."""
    return wide.select(col(key), _line(period_cols)["slope"].alias("slope"))


def trend_fitted(wide: DataFrame, key: str, period_cols: Sequence[str]) -> DataFrame:
    """(key, fitted_0, fitted_1, ..., fitted_mean)."""
    line = _line(period_cols)
    fitted = [line["intercept"] + line["slope"] * float(i) for i in range(len(period_cols))]
    return wide.select(
        col(key), *[f.alias(f"fitted_{i}") for i, f in enumerate(fitted)],
        (sum(fitted, F.lit(0.0)) / len(fitted)).alias("fitted_mean"))


def revenue_ranking(wide: DataFrame, item_col: str, item: str, key: str, period: str) -> DataFrame:
    """One line item's parsed values, largest first."""
    return (
        wide.filter(col(item_col) == item)
        .select(col(key), fn_strip_thousands(col(period)).alias("value"))
        .orderBy(F.desc_nulls_last("value"), col(key)))


def sector_mix_of_top_k(slopes: DataFrame, dim: DataFrame, key: str, dim_key: str, attr: str, k: int = 20,
                        largest: bool = True) -> DataFrame:
    """How often each attribute value occurs among the k steepest (or most falling) trends."""
    pick = top_k if largest else bottom_k
    return value_counts(join_dimension(pick(slopes, "slope", k, key), dim, key, dim_key), attr)
