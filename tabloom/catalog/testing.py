"""Statistical tests and trends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import stats as T
from ..plans.revenue import yearly_revenue
from .base import query, rounded


@query("anova_oneway", """
    WITH g AS (SELECT event_type, count(*) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1),
    a AS (SELECT avg(value) AS grand FROM events)
    SELECT round((sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS f,
           CAST(count(*) - 1 AS BIGINT) AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within FROM g, a""")
def _(t):
    return rounded(T.anova_oneway(t.events, "value", "event_type").select("f", "df_between", "df_within"))


@query("anova_p_value")
def _(t):
    return T.anova_oneway(t.lineitem, "l_extendedprice", "l_linenumber")


@query("ttest_independent", """
    WITH m AS (SELECT count(*) FILTER (event_type = 'click') AS n1, count(*) FILTER (event_type = 'view') AS n2,
      avg(value) FILTER (event_type = 'click') AS m1, avg(value) FILTER (event_type = 'view') AS m2,
      var_samp(value) FILTER (event_type = 'click') AS v1, var_samp(value) FILTER (event_type = 'view') AS v2 FROM events)
    SELECT round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t,
           n1 + n2 - 2 AS df FROM m""")
def _(t):
    return rounded(T.ttest_independent(t.events, "value", "event_type", "click", "view").select("t", "df"))


_KS_P = " ".join(f"WHEN {g} THEN {p}" for g, p in T.KS_TEN_BY_TEN.items())
_KS_TAIL = f"""
    s AS (SELECT column_name, label, min(value) AS lo, max(value) AS hi FROM v GROUP BY 1, 2),
    c AS (SELECT v.column_name, v.label, CAST(least(floor((value - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, count(*) AS n
          FROM v JOIN s ON v.column_name = s.column_name AND v.label = s.label GROUP BY 1, 2, 3),
    g AS (SELECT column_name, label, bin FROM s, range(10) r(bin)),
    n AS (SELECT g.column_name, g.label, coalesce(n, 0) AS n FROM g LEFT JOIN c
          ON g.column_name = c.column_name AND g.label = c.label AND g.bin = c.bin),
    h AS (SELECT column_name, label, CAST(n - min(n) OVER w AS DOUBLE) / (max(n) OVER w - min(n) OVER w) AS height
          FROM n WINDOW w AS (PARTITION BY column_name, label)),
    e AS (SELECT column_name, abs(sum(CASE WHEN label = 1 THEN 1 ELSE -1 END)
                 OVER (PARTITION BY column_name ORDER BY height RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS gap FROM h),
    d AS (SELECT column_name, CAST(max(gap) AS INTEGER) AS gap FROM e GROUP BY 1)
    SELECT column_name, round(gap / 10.0, 6) AS d, round(CAST(CASE gap {_KS_P} END AS DOUBLE), 6) AS p,
           CASE gap {_KS_P} END < 0.05 AS differs FROM d"""
_KS_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]


@query("ks_histogram_numeric", "WITH l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(l_linestatus = 'F' AS INTEGER) AS label, CAST({c} AS DOUBLE) AS value FROM lineitem"
    for c in _KS_NUMERIC) + f"""),
    q AS (SELECT column_name, quantile_cont(value, 0.003) AS qlo, quantile_cont(value, 0.997) AS qhi FROM l GROUP BY 1),
    v AS (SELECT l.* FROM l JOIN q ON l.column_name = q.column_name WHERE value BETWEEN qlo AND qhi),{_KS_TAIL}""")
def _(t):
    lines = t.lineitem.withColumn("label", (F.col("l_linestatus") == "F").cast("int"))
    return rounded(T.ks_histogram_numeric(lines, _KS_NUMERIC, "label"))


@query("ks_histogram_categorical", """
    WITH j AS (SELECT d.lang, d.source, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    v AS (SELECT 'lang' AS column_name, toxic AS label, dense_rank() OVER (ORDER BY lang) - 1 AS value FROM j
          UNION ALL SELECT 'source', toxic, dense_rank() OVER (ORDER BY source) - 1 FROM j),""" + _KS_TAIL)
def _(t):
    return rounded(T.ks_histogram_categorical(t.documents.join(t.labels, "doc_id"), ["lang", "source"], "toxic"))


# ---- trends ---------------------------------------------------------------------------

_PERIODS = ["y1997", "y1998", "y1999", "y2000"]
_REVENUE = """revenue AS (
  SELECT c_nationkey AS symbol, year(o_orderdate) - 1997 AS x, round(sum(o_totalprice), 2) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1997 AND 2000 GROUP BY 1, 2)"""


def _revenue(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return yearly_revenue(joined, "c_nationkey", "o_orderdate", "o_totalprice", [1997, 1998, 1999, 2000])


def _slopes(t):
    return T.trend_slope(_revenue(t).filter(F.col("item") == "Total Revenue"), "symbol", _PERIODS)


@query("trend_slope", f"WITH {_REVENUE} SELECT symbol, round(regr_slope(y, x), 4) AS slope FROM revenue GROUP BY 1")
def _(t):
    return rounded(_slopes(t), 4)


@query("trend_fitted", f"""
    WITH {_REVENUE}, l AS (SELECT symbol, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM revenue GROUP BY 1)
    SELECT symbol, round(a, 4) AS fitted_0, round(a + b, 4) AS fitted_1, round(a + 2 * b, 4) AS fitted_2,
           round(a + 3 * b, 4) AS fitted_3, round(a + 1.5 * b, 4) AS fitted_mean FROM l""")
def _(t):
    return rounded(T.trend_fitted(_revenue(t).filter(F.col("item") == "Total Revenue"), "symbol", _PERIODS), 4)


@query("revenue_ranking", f"WITH {_REVENUE} SELECT symbol, y AS value FROM revenue WHERE x = 3 ORDER BY y DESC, symbol")
def _(t):
    return T.revenue_ranking(_revenue(t), "item", "Total Revenue", "symbol", "y2000")


def _mix_sql(direction: str) -> str:
    return f"""
    WITH {_REVENUE}, s AS (SELECT symbol, regr_slope(y, x) AS slope FROM revenue GROUP BY 1),
    k AS (SELECT symbol FROM s ORDER BY slope {direction}, symbol LIMIT 10)
    SELECT '{direction}' AS direction, r_name, count(*) AS count FROM k JOIN nation ON symbol = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY 2"""


@query("sector_mix_of_top_k", f"SELECT * FROM ({_mix_sql('DESC')}) UNION ALL SELECT * FROM ({_mix_sql('ASC')})")
def _(t):
    dim = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    slopes = _slopes(t)
    mixes = [T.sector_mix_of_top_k(slopes, dim, "symbol", "n_nationkey", "r_name", 10, largest).select(
        F.lit(d).alias("direction"), "r_name", "count") for d, largest in (("DESC", True), ("ASC", False))]
    return reduce(DataFrame.unionAll, mixes)
