"""Filling, encoding and feature engineering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prepare as E
from ..operators import profile as P
from ..operators import ranks as K
from .base import CASES, OFFSETS, READINGS, query, rounded


@query("fill_constant", f"""
    WITH {CASES} SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM cases""")
def _(t):
    return E.fill_constant(t.cases.select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query("fill_null_token", f"""
    WITH {CASES} SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), 'nullstr') AS quality FROM cases""")
def _(t):
    return E.fill_null_token(t.cases.select("doc_id", "lang", "quality"), ["lang", "quality"])


@query("impute_mean", f"""
    WITH {READINGS} SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM readings)), 6) AS value FROM readings""")
def _(t):
    return rounded(E.impute_mean(t.readings.select("event_id", "value"), ["value"]))


@query("impute_mode", f"""
    WITH {CASES}, m AS (SELECT quality FROM cases WHERE quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1),
    n AS (SELECT toxic FROM cases WHERE toxic IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, toxic LIMIT 1)
    SELECT doc_id, coalesce(c.quality, m.quality) AS quality, coalesce(c.toxic, n.toxic) AS toxic FROM cases c, m, n""")
def _(t):
    return E.impute_mode(t.cases.select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query("impute_chained", """
    WITH l AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
                      CASE WHEN l_returnflag <> 'A' THEN l_quantity * 1000 + l_extendedprice END AS price FROM lineitem),
    f AS (SELECT regr_slope(price, l_quantity) AS b, regr_intercept(price, l_quantity) AS a FROM l)
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(coalesce(price, a + b * l_quantity), 4) AS price FROM l, f""")
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity") * 1000 + F.col("l_extendedprice")).alias("price"))
    return rounded(E.impute_chained(lines, ["l_quantity", "price"], regression="least_squares"), 4)


@query("impute_chained_ridge", """
    WITH RECURSIVE l AS (SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag <> 'A' THEN l_quantity * 10 + l_extendedprice / 100 END AS price FROM lineitem),
    m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(price) AS my FROM l WHERE price IS NOT NULL),
    s AS (SELECT n, mx, my, sum((l_quantity - mx) ** 2) AS xx, sum((l_quantity - mx) * (price - my)) AS xy, sum((price - my) ** 2) AS yy
          FROM l, m WHERE price IS NOT NULL GROUP BY ALL),
    e AS (SELECT 0 AS i, n / yy AS alpha, 1.0::DOUBLE AS penalty, CAST(NULL AS DOUBLE) AS w, CAST(NULL AS DOUBLE) AS old FROM s
          UNION ALL SELECT i + 1, (n - g + 2e-6) / (greatest(yy - 2 * v * xy + v * v * xx, 0) + 2e-6), (g + 2e-6) / (v * v + 2e-6), v, w
          FROM (SELECT *, xy / (xx + penalty / alpha) AS v, alpha * xx / (penalty + alpha * xx) AS g FROM e, s)
          WHERE i < 300 AND (old IS NULL OR abs(old - w) >= 1e-3)),
    f AS (SELECT xy / (xx + penalty / alpha) AS b, mx, my FROM e, s ORDER BY i DESC LIMIT 1)
    SELECT l_orderkey, l_linenumber, l_quantity, round(coalesce(price, my + b * (l_quantity - mx)), 4) AS price FROM l, f""")
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity") * 10 + F.col("l_extendedprice") / 100).alias("price"))
    return rounded(E.impute_chained(lines, ["l_quantity", "price"]), 4)


@query("impute_chained_many")
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_discount", "l_quantity",
        F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice") * F.col("l_tax")).alias("l_taxed"))
    return E.impute_chained(lines, ["l_discount", "l_quantity", "l_extendedprice", "l_taxed"])


@query("rare_to_others", """
    SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_brand) < 80 THEN 'others' ELSE p_brand END AS p_brand,
           CASE WHEN count(*) OVER (PARTITION BY p_name) < 30 THEN 'others' ELSE p_name END AS p_name FROM part""")
def _(t):
    return E.rare_to_others(t.part.select("p_partkey", "p_brand", "p_name"), {"p_brand": 80, "p_name": 30})


@query("feature_cross", f"""
    WITH {CASES} SELECT doc_id, lang, quality, source, lang || '_' || coalesce(CAST(quality AS VARCHAR), 'nan') AS lang_quality,
           lang || '_' || coalesce(CAST(quality AS VARCHAR), 'nan') || '_' || source AS lang_quality_source FROM cases""")
def _(t):
    once = E.feature_cross(t.cases.select("doc_id", "lang", "quality", "source"), "lang", "quality")
    return E.feature_cross(once, "lang_quality", "source")


@query("label_encode", f"""
    WITH {CASES} SELECT doc_id, dense_rank() OVER (ORDER BY lang) - 1 AS lang, dense_rank() OVER (ORDER BY source) - 1 AS source,
           dense_rank() OVER (ORDER BY coalesce(CAST(quality AS VARCHAR), 'nan')) - 1 AS quality FROM cases""")
def _(t):
    return E.label_encode(t.cases.select("doc_id", "lang", "source", "quality"), ["lang", "source", "quality"])


@query("label_encode_fit_transform", """
    WITH codes AS (SELECT c_mktsegment AS v, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code
                   FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal > 9000))
    SELECT c_custkey, code AS c_mktsegment FROM customer LEFT JOIN codes ON c_mktsegment = v""")
def _(t):
    customers = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return E.label_encode(customers.drop("c_acctbal"), ["c_mktsegment"], fit_on=customers.filter("c_acctbal > 9000"))


@query("label_encode_date", """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY strftime(o_orderdate, '%Y%m%d')) - 1 AS INTEGER) AS date_code FROM orders""")
def _(t):
    return K.label_encode_date(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("time_month_index", f"""
    WITH {OFFSETS}, m AS (SELECT event_id, seconds, TIMESTAMP '2017-11-30' + to_seconds(seconds) AS ts FROM offsets)
    SELECT event_id, seconds, CAST((year(ts) - 2017) * 12 + month(ts) AS INTEGER) AS "DT_M" FROM m""")
def _(t):
    return E.time_month_index(t.offsets.select("event_id", "seconds"), "seconds")


@query("zscore", """
    WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                      stddev_samp(l_extendedprice) AS sp FROM lineitem)
    SELECT l_orderkey, l_partkey, l_linenumber, l_linestatus, round((l_quantity - mq) / (sq + 1e-6), 6) + 0.0 AS l_quantity,
           round((l_extendedprice - mp) / (sp + 1e-6), 6) + 0.0 AS l_extendedprice FROM lineitem, s""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_quantity", "l_extendedprice")
    scaled = rounded(E.zscore(lines, ["l_quantity", "l_extendedprice"]))
    # A tiny negative value rounds to a negative zero or not: adding zero settles it.
    return scaled.withColumns({n: F.col(n) + 0.0 for n in ("l_quantity", "l_extendedprice")})


@query("skew_log_transform", """
    SELECT event_id, CAST(user_id AS DOUBLE) AS user_id,
           round(log10(exp(value / 100) + 1 - least(0, (SELECT min(exp(value / 100)) FROM events))), 6) AS v FROM events""")
def _(t):
    events = t.events.select("event_id", F.col("user_id").cast("double").alias("user_id"), F.exp(F.col("value") / 100).alias("v"))
    return rounded(E.skew_log_transform(events, ["user_id", "v"]))


@query("narrow_types", """
    SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, CAST(p_size AS TINYINT) AS p_size, CAST(p_retailprice AS FLOAT) AS p_retailprice
    FROM part""")
def _(t):
    return E.narrow_types(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_partkey", "p_size", "p_retailprice"])


@query("narrow_types_report", """
    SELECT count(*) * 20 AS bytes_before, count(*) * 7 AS bytes_after, CAST(65 AS DOUBLE) AS saved_percent FROM part""")
def _(t):
    part = t.part.select("p_partkey", "p_size", "p_retailprice")
    return E.narrow_types_report(part, E.narrow_types(part, part.columns))


_MONEY = """money AS (
  SELECT l_quantity AS qty, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS net,
         CASE WHEN l_returnflag <> 'A' THEN l_extendedprice * (1 + l_tax) END AS gross, l_discount AS discount FROM lineitem)"""
_MONEY_COLUMNS = ["qty", "price", "net", "gross", "discount"]


def _money(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        F.col("l_quantity").alias("qty"), price.alias("price"), (price * (1 - F.col("l_discount"))).alias("net"),
        F.when(F.col("l_returnflag") != "A", price * (1 + F.col("l_tax"))).alias("gross"), F.col("l_discount").alias("discount"))


def _drop_list(money):
    return E.high_corr_drop_list(P.corr_pairs(money, _MONEY_COLUMNS), P.null_profile(money), 0.8)


_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM money"
    for a in sorted(_MONEY_COLUMNS) for b in sorted(_MONEY_COLUMNS) if a < b)
_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) - count({c}) AS nulls FROM money" for c in _MONEY_COLUMNS)


@query("high_corr_drop_list", f"""
    WITH {_MONEY}, pairs AS ({_PAIRS}), nulls AS ({_NULLS}),
    victims AS (SELECT row_number() OVER (ORDER BY r DESC, a, b) AS place, CASE WHEN na.nulls > nb.nulls THEN a ELSE b END AS column_name
                FROM pairs JOIN nulls na ON a = na.c JOIN nulls nb ON b = nb.c WHERE r >= 0.8)
    SELECT CAST(row_number() OVER (ORDER BY min(place)) AS INTEGER) AS position, column_name FROM victims GROUP BY column_name""")
def _(t):
    return _drop_list(_money(t))


@query("drop_high_corr", f"""
    WITH {_MONEY} SELECT round(qty, 6) AS qty, round(net, 6) AS net, round(discount, 6) AS discount FROM money""")
def _(t):
    money = _money(t)
    victims = [r["column_name"] for r in _drop_list(money).collect()]
    return rounded(E.drop_high_corr(money, [*victims, "not_there"]))
