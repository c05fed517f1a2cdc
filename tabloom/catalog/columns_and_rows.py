"""Scans, sinks, projections, filters, joins, sets, ranks, sorts, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources as S
from ..functions import scalars as C
from ..operators import ranks as K
from ..operators import relational as R
from ..operators.prepare import fit_label_codes
from ..session import scratch_path
from .base import CASES, OFFSETS, READINGS, query, rounded

# ---- scans and sinks ------------------------------------------------------------------


@query("csv_scan_typed", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    part = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return S.csv_scan_typed(t.spark, S.csv_sink(part, scratch_path(t.spark, "orders")), part.schema)


@query("csv_scan_inferred", """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def _(t):
    return S.csv_scan_inferred(t.spark, S.csv_sink(t.customer, scratch_path(t.spark, "customer")))


@query("csv_scan_renamed", """
    SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS label, s_nationkey AS nation, s_acctbal AS balance FROM supplier""")
def _(t):
    path = S.csv_sink(t.supplier, scratch_path(t.spark, "supplier"))
    return S.csv_scan_renamed(t.spark, path, ["id", "label", "nation", "balance"])


@query("csv_sink", f"WITH {READINGS} SELECT * FROM readings")
def _(t):
    path = S.csv_sink(t.readings, scratch_path(t.spark, "readings"), stamp=True)
    return S.csv_scan_typed(t.spark, path, t.readings.schema)


@query("stage_snapshot", f"WITH {READINGS} SELECT * FROM readings")
def _(t):
    path = scratch_path(t.spark, "stage")
    S.stage_snapshot(t.readings, path, "function")
    return S.stage_snapshot(None, path, "stored", t.spark)


@query("preview_shape", """
    SELECT o_orderkey, o_custkey, o_totalprice, (SELECT count(*) FROM orders) AS n_rows, CAST(6 AS INTEGER) AS n_cols
    FROM orders ORDER BY o_orderkey LIMIT 5""")
def _(t):
    head, rows, cols = S.preview_shape(t.orders, 5, "o_orderkey")
    return head.select("o_orderkey", "o_custkey", "o_totalprice", F.lit(rows).cast("long").alias("n_rows"),
                       F.lit(cols).alias("n_cols"))


# ---- projections and filters ----------------------------------------------------------


@query("select_columns", "SELECT l_orderkey, l_quantity, l_discount FROM lineitem")
def _(t):
    return R.select_columns(t.lineitem, ["l_orderkey", "l_quantity", "l_discount"])


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    strict = R.drop_columns(t.orders, ["o_orderdate"])
    return R.drop_columns(strict, ["o_orderpriority", "not_there"], strict=False)


@query("rename_columns", """
    SELECT c_custkey AS id, c_name AS "c-name", c_nationkey AS "c-nationkey", c_acctbal AS "c-acctbal",
           c_mktsegment AS "c-mktsegment" FROM customer""")
def _(t):
    return R.rename_pattern(R.rename_columns(t.customer, {"c_custkey": "id"}), "c_", "c-")


@query("cast_columns", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_brand FROM part""")
def _(t):
    return R.cast_columns(t.part.select("p_partkey", "p_size", "p_brand"), {"p_partkey": "string", "p_size": "double"})


@query("filter_equals", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return R.filter_equals(t.orders, "o_orderstatus", "F").select("o_orderkey", "o_totalprice")


@query("filter_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(t):
    return R.filter_in(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"]).select("o_orderkey", "o_orderpriority")


@query("filter_is_null", f"WITH {CASES} SELECT doc_id, lang FROM cases WHERE toxic IS NULL")
def _(t):
    return R.filter_is_null(t.cases, "toxic").select("doc_id", "lang")


@query("filter_range_quantile", """
    WITH q AS (SELECT quantile_cont(value, 0.003) AS lo, quantile_cont(value, 0.997) AS hi FROM events)
    SELECT event_id, value FROM events, q WHERE value BETWEEN lo AND hi""")
def _(t):
    return R.filter_range_quantile(t.events, "value").select("event_id", "value")


@query("drop_null_rows", f"WITH {CASES} SELECT * FROM cases WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def _(t):
    return R.drop_null_rows(t.cases, ["quality", "toxic"])


@query("recode_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS o_orderstatus
    FROM orders""")
def _(t):
    return R.recode_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "finished", "O": "open"})


@query("drop_cols_null_pct", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(t):
    return R.drop_cols_null_pct(t.cases, 50)


@query("drop_cols_null_count", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    return R.drop_cols_null_count(t.readings, 10)


@query("split_by_dtype", """
    SELECT p_partkey, 'numeric' AS block, CAST(p_size AS DOUBLE) AS p_size, p_retailprice, NULL AS p_brand, NULL AS p_type FROM part
    UNION ALL SELECT p_partkey, 'categorical', NULL, NULL, p_brand, p_type FROM part""")
def _(t):
    part = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", "p_brand", "p_type")
    numeric, categorical = R.split_by_dtype(part, "p_partkey")
    return numeric.withColumn("block", F.lit("numeric")).unionByName(
        categorical.withColumn("block", F.lit("categorical")), allowMissingColumns=True)


@query("pop_label", "SELECT l.doc_id, l.quality, l.toxic AS target FROM labels l")
def _(t):
    features, target = R.pop_label(t.labels, "doc_id", "toxic")
    return features.join(target.withColumnRenamed("toxic", "target"), "doc_id")


@query("low_cardinality_columns", """
    WITH long AS (
      SELECT DISTINCT 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
      UNION ALL SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem
      UNION ALL SELECT DISTINCT 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM lineitem)
    SELECT column_name, count(*) AS distinct_values, string_agg(value, ',' ORDER BY value) AS values
    FROM long GROUP BY 1 HAVING count(*) < 3""")
def _(t):
    return R.low_cardinality_columns(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


# ---- joins ----------------------------------------------------------------------------

_DOCS_LABELS = """
    SELECT d.doc_id, d.lang, CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
    FROM documents d {} JOIN labels l ON d.doc_id = l.doc_id"""


def _docs(t):
    return t.documents.select("doc_id", "lang", F.col("n_chars").cast("double").alias("n_chars"))


@query("join_left", _DOCS_LABELS.format("LEFT"))
def _(t):
    return R.join_left(_docs(t), t.marks, "doc_id")


@query("join_right", _DOCS_LABELS.format("LEFT"))
def _(t):
    return R.join_right(t.marks, _docs(t), "doc_id")


@query("join_outer", """
    SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, CAST(d.n_chars AS DOUBLE) AS n_chars,
           CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
    FROM (SELECT * FROM documents WHERE lang <> 'en') d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    return R.join_outer(_docs(t).filter("lang <> 'en'"), t.marks, "doc_id")


@query("join_feature_blocks", "SELECT p_partkey, p_size, p_retailprice, p_name, p_brand, p_type FROM part")
def _(t):
    return R.join_feature_blocks(*R.split_by_dtype(t.part, "p_partkey"), "p_partkey")


@query("join_label_to_feature", f"WITH {READINGS} SELECT event_id, value, event_type, user_id FROM readings")
def _(t):
    return R.join_label_to_feature(t.events, t.readings.select("event_id", "value"), "event_id", ["event_type", "user_id"])


@query("join_dimension", """
    SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    return R.join_dimension(t.customer.select("c_custkey", "c_nationkey"), t.nation, "c_nationkey", "n_nationkey")


@query("join_lookup_map", """
    SELECT o_orderkey, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS priority_code FROM orders""")
def _(t):
    codes = fit_label_codes(t.orders, ["o_orderpriority"]).codes.withColumnRenamed("value", "o_orderpriority")
    return R.join_lookup_map(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", codes, "code", "priority_code")


@query("join_submission", """
    SELECT d.doc_id, CAST(l.quality * 0.5 + l.toxic * 0.25 AS DOUBLE) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ORDER BY d.doc_id""")
def _(t):
    template = t.documents.select("doc_id", F.lit(0.5).alias("quality"))
    predictions = t.labels.select("doc_id", (F.col("quality") * 0.5 + F.col("toxic") * 0.25).alias("score"))
    return R.join_submission(template, predictions, "doc_id", "quality", "score")


# ---- sets -----------------------------------------------------------------------------


@query("key_overlap", """
    SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) AS in_both,
           (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS only_left,
           (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS only_right""")
def _(t):
    return R.key_overlap(t.documents, t.labels, "doc_id")


@query("union_rows", """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    f, o = R.filter_equals(orders, "o_orderstatus", "F"), R.filter_equals(orders, "o_orderstatus", "O")
    return R.union_rows(f, o, f)


@query("concat_columns", _DOCS_LABELS.format("FULL"))
def _(t):
    return R.concat_columns(_docs(t), t.marks, "doc_id")


_DEDUP = """
    SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate {0}, o_orderkey {0}) = 1"""


@query("dedup_keep_first", _DEDUP.format("ASC"))
def _(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return R.dedup_keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("dedup_keep_last", _DEDUP.format("DESC"))
def _(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return R.dedup_keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("dedup_full_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def _(t):
    return R.dedup_keep_first(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("distinct_values", f"WITH {CASES} SELECT DISTINCT quality FROM cases")
def _(t):
    return R.distinct_values(t.cases, "quality")


@query("ordered_distinct", "SELECT o_custkey, min(o_orderkey) AS first_position FROM orders GROUP BY 1 ORDER BY 2")
def _(t):
    return R.ordered_distinct(t.orders, "o_custkey", "o_orderkey")


# ---- ranks and sorts ------------------------------------------------------------------


@query("dense_rank_date", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CAST(dense_rank() OVER (ORDER BY strftime(l_shipdate, '%Y-%m-%d')) AS INTEGER) AS day_rank FROM lineitem""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    return K.dense_rank_date(rows, "l_shipdate").drop("l_shipdate")


@query("dense_rank_year_month", """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY strftime(o_orderdate, '%Y-%m')) AS INTEGER) AS month_rank FROM orders""")
def _(t):
    return K.dense_rank_year_month(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("day_ordinal_offset", """
    SELECT o_orderkey, CAST(364 + dense_rank() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%d')) AS INTEGER) AS day_ordinal
    FROM orders""")
def _(t):
    return K.day_ordinal_offset(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("global_row_index", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders""")
def _(t):
    return K.global_row_index(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("sort_by", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(t):
    return R.sort_by(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], [False, True])


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return R.top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


@query("bottom_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 20")
def _(t):
    return R.bottom_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, "o_orderkey")


# ---- scalar functions -----------------------------------------------------------------


@query("fn_strip_thousands", """
    SELECT o_orderkey, CAST(replace(format('{:,.2f}', o_totalprice), ',', '') AS DOUBLE) AS amount FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.fn_strip_thousands(F.format_number("o_totalprice", 2)).alias("amount"))


@query("fn_concat_key", f"""
    WITH {CASES} SELECT doc_id, coalesce(lang, 'nan') || '_' || coalesce(CAST(quality AS VARCHAR), 'nan') AS k FROM cases""")
def _(t):
    return t.cases.select("doc_id", C.fn_concat_key(F.col("lang"), F.col("quality")).alias("k"))


@query("fn_as_string", f"WITH {CASES} SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'nan') AS quality FROM cases")
def _(t):
    return t.cases.select("doc_id", C.fn_as_string(F.col("quality")).alias("quality"))


@query("fn_zfill_year_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def _(t):
    return t.orders.select("o_orderkey", C.fn_zfill_year_month(F.col("o_orderdate")).alias("year_month"))


@query("fn_replace_token", "SELECT doc_id, replace(source, 'src', 'source-') AS source FROM documents")
def _(t):
    return t.documents.select("doc_id", C.fn_replace_token(F.col("source"), "src", "source-").alias("source"))


@query("fn_epoch_to_ts", f"""
    WITH {OFFSETS} SELECT event_id, strftime(make_timestamp(seconds * 1000000), '%Y-%m-%d %H:%M:%S') AS moment FROM offsets""")
def _(t):
    return t.offsets.select("event_id", F.date_format(C.fn_epoch_to_ts(F.col("seconds")), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("fn_start_plus_seconds", f"""
    WITH {OFFSETS} SELECT event_id,
           strftime(TIMESTAMP '2017-11-30' + to_seconds(seconds), '%Y-%m-%d %H:%M:%S') AS moment FROM offsets""")
def _(t):
    moment = C.fn_start_plus_seconds(F.col("seconds"), "2017-11-30")
    return t.offsets.select("event_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query("fn_date_format", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y%m%d') AS compact,
           strftime(o_orderdate, '%Y') AS year FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", C.fn_date_format(d).alias("day"), C.fn_date_format(d, "yyyyMMdd").alias("compact"),
                           C.fn_date_format(d, "yyyy").alias("year"))


@query("fn_month_index", """
    SELECT o_orderkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS month_index FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", C.fn_month_index(F.col("o_orderdate"), 1995).alias("month_index"))


@query("fn_log10_shift", """
    SELECT c_custkey, round(log10(c_acctbal + 1 - least(0, (SELECT min(c_acctbal) FROM customer))), 6) AS v FROM customer""")
def _(t):
    low = t.customer.agg(F.min("c_acctbal")).first()[0]
    return rounded(t.customer.select("c_custkey", C.fn_log10_shift(F.col("c_acctbal"), low).alias("v")))


@query("fn_abs", "SELECT c_custkey, abs(c_acctbal) AS v FROM customer")
def _(t):
    return t.customer.select("c_custkey", C.fn_abs(F.col("c_acctbal")).alias("v"))


@query("fn_round_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS v FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", C.fn_round_even(F.col("l_quantity") / 2).alias("v"))
