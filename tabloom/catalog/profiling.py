"""Profiles and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from .base import CASES, query, rounded

_CASE_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _each(names, template: str) -> str:
    """The same SELECT for several columns."""
    return " UNION ALL ".join(template.format(c=n) for n in names)


@query("null_profile", f"WITH {CASES} " + _each(_CASE_COLUMNS, """
    SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
           round((count(*) - count({c})) * 100.0 / count(*), 6) AS nan_percent FROM cases"""))
def _(t):
    return rounded(P.null_profile(t.cases))


@query("row_null_counts", f"""
    WITH {CASES} SELECT doc_id, CAST((quality IS NULL)::INT + (toxic IS NULL)::INT AS INTEGER) AS null_count,
           round(((quality IS NULL)::INT + (toxic IS NULL)::INT) * 100.0 / 5, 6) AS null_percent FROM cases""")
def _(t):
    return rounded(P.row_null_counts(t.cases, "doc_id"))


@query("null_pct_shift_after_join", f"WITH {CASES} " + _each(["quality", "toxic"], """
    SELECT '{c}' AS column_name, round(b, 6) AS before, round(a, 6) AS after, round(a - b, 6) AS shift
    FROM (SELECT (count(*) - count({c})) * 100.0 / count(*) AS b FROM labels),
         (SELECT (count(*) - count({c})) * 100.0 / count(*) AS a FROM cases)"""))
def _(t):
    return rounded(P.null_pct_shift_after_join(t.marks, t.cases, ["quality", "toxic"]))


@query("null_total_assert", f"""
    WITH {CASES} SELECT count(*) * 2 - count(quality) - count(toxic) AS null_total FROM cases""")
def _(t):
    return P.null_total_assert(t.cases, raise_on_nonzero=False)


@query("value_counts", "SELECT source, count(*) AS count FROM documents GROUP BY 1 ORDER BY 2 DESC, 1")
def _(t):
    return P.value_counts(t.documents, "source")


@query("value_counts_normalized", """
    SELECT source, lang, count(*) AS count, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY source), 6) AS frequency
    FROM documents GROUP BY 1, 2""")
def _(t):
    return rounded(P.value_counts_normalized(t.documents, "lang", "source"))


@query("count_of_counts", """
    SELECT occurrences, count(*) AS keys FROM (SELECT count(*) AS occurrences FROM orders GROUP BY o_custkey) GROUP BY 1""")
def _(t):
    return P.count_of_counts(t.orders, "o_custkey")


@query("row_counts", """
    SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'documents', count(*) FROM documents""")
def _(t):
    return P.row_counts(orders=t.orders, lineitem=t.lineitem, documents=t.documents)


@query("describe", _each(_LINE_COLUMNS, """
    SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           min({c}) + 0.0 AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
           round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max FROM lineitem"""))
def _(t):
    return rounded(P.describe(t.lineitem, _LINE_COLUMNS), 4)


_STATISTICS = {
    "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "q25": "quantile_cont({c}, 0.25)",
    "q50": "quantile_cont({c}, 0.5)", "q75": "quantile_cont({c}, 0.75)"}


@query("describe_by_class", " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS column_name, '{s}' AS statistic, round({e.format(c=c)}, 4) AS value FROM lineitem GROUP BY 1"
    for c in _LINE_COLUMNS[:2] for s, e in _STATISTICS.items()))
def _(t):
    return rounded(P.describe_by_class(t.lineitem, "l_returnflag", _LINE_COLUMNS[:2]), 4)


@query("column_mean_std", _each(_LINE_COLUMNS, """
    SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std FROM lineitem"""))
def _(t):
    return rounded(P.column_mean_std(t.lineitem, _LINE_COLUMNS), 4)


@query("column_min_max", _each(_LINE_COLUMNS, """
    SELECT '{c}' AS column_name, min({c}) + 0.0 AS min, max({c}) + 0.0 AS max FROM lineitem"""))
def _(t):
    return P.column_min_max(t.lineitem, _LINE_COLUMNS).select(
        "column_name", (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))


@query("skew_profile", """
    SELECT 'value' AS column_name, round(skewness(value), 6) AS skew FROM events
    UNION ALL SELECT 'user_id', round(skewness(user_id), 6) FROM events""")
def _(t):
    return rounded(P.skew_profile(t.events, ["value", "user_id"]))


@query("mode_value", "SELECT p_brand, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def _(t):
    return P.mode_value(t.part, "p_brand")


@query("quantiles", " UNION ALL ".join(
    f"SELECT CAST({q} AS DOUBLE) AS q, round(quantile_cont(o_totalprice, {q}), 4) AS value FROM orders"
    for q in (0.003, 0.25, 0.5, 0.75, 0.997)))
def _(t):
    return rounded(P.quantiles(t.orders, "o_totalprice", [0.003, 0.25, 0.5, 0.75, 0.997]), 4)


@query("distinct_count", _each(["l_partkey", "l_suppkey", "l_returnflag"], """
    SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem"""))
def _(t):
    return P.distinct_count(t.lineitem, ["l_partkey", "l_suppkey", "l_returnflag"])


def _histogram_sql(bins: int) -> str:
    return f"""
    WITH s AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
    c AS (SELECT e.event_type, CAST(least(floor((value - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin,
                 count(*) AS n FROM events e JOIN s ON e.event_type = s.event_type GROUP BY 1, 2),
    g AS (SELECT event_type, lo, hi, CAST(bin AS INTEGER) AS bin FROM s, range({bins}) r(bin))
    SELECT g.event_type, g.bin, round(lo + g.bin * ((hi - lo) / {bins}), 6) AS bin_low,
           round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 6) AS bin_high, coalesce(n, 0) AS count
    FROM g LEFT JOIN c ON g.event_type = c.event_type AND g.bin = c.bin"""


@query("histogram", _histogram_sql(25))
def _(t):
    return rounded(P.histogram(t.events, "value", 25, "event_type"))


@query("histogram_minmax", f"""
    WITH h AS ({_histogram_sql(10)})
    SELECT *, round((count - min(count) OVER w) * 1.0 / (max(count) OVER w - min(count) OVER w), 6) AS height
    FROM h WINDOW w AS (PARTITION BY event_type)""")
def _(t):
    return rounded(P.histogram_minmax(t.events, "value", 10, "event_type"))


@query("box_stats", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                      quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
    j AS (SELECT e.event_type, q1, median, q3, value,
                 value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM events e JOIN q ON e.event_type = q.event_type)
    SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high,
           count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY event_type, q1, median, q3""")
def _(t):
    return rounded(P.box_stats(t.events, "value", "event_type"))


def _corr_sql(names, shape: str) -> str:
    pairs = [(a, b) for a in sorted(names) for b in sorted(names) if shape == "matrix" or a < b]
    value = "round(corr({a}, {b}), 6) AS r" if shape == "matrix" else "round(abs(corr({a}, {b})), 6) AS abs_r"
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {value.format(a=a, b=b)} FROM lineitem" for a, b in pairs)


@query("corr_matrix", _corr_sql(_LINE_COLUMNS, "matrix"))
def _(t):
    return rounded(P.corr_matrix(t.lineitem, _LINE_COLUMNS))


@query("corr_pairs", _corr_sql(_LINE_COLUMNS, "pairs"))
def _(t):
    return rounded(P.corr_pairs(t.lineitem, _LINE_COLUMNS))


@query("count_per_time_bucket", """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS rows FROM events GROUP BY 1""")
def _(t):
    return P.count_per_time_bucket(t.events, "ts", "1 hour").withColumn(
        "bucket_start", F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss"))


@query("count_by_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1")
def _(t):
    return P.count_by_year(t.orders, "o_orderdate")
