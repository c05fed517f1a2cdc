"""Metrics, models and whole flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import models as L
from ..operators.splits import split_random, split_stratified
from ..plans.consistency import consistent_features
from ..plans.preparation import Preparation
from ..plans.scoring import train_and_submit
from ..plans.time_split import evaluate_over_time
from ..session import scratch_path
from ..sources import csv_scan_typed
from .base import SCORED, query, rounded

# ---- metrics --------------------------------------------------------------------------


@query("auc_roc", f"""
    WITH {SCORED}, c AS (SELECT score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY 1),
    r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
    SELECT round(CAST(sum(pos * (before + neg / 2)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc FROM r""")
def _(t):
    return rounded(M.auc_roc(t.scored, "y", "score"))


@query("threshold_labels", """
    SELECT event_id, CAST(round_even(least(value / 100, 1), 0) AS INTEGER) AS predicted FROM events""")
def _(t):
    return M.threshold_labels(t.scored, "score").select("event_id", "predicted")


@query("confusion_counts", f"""
    WITH {SCORED} SELECT count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp,
           count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 1 AND yhat = 0) AS fn FROM scored""")
def _(t):
    return M.confusion_counts(t.scored, "y", "yhat")


_MATRIX = """
    SELECT a.v AS truth, b.v AS predicted, count(s.event_id) AS count
    FROM (VALUES (0), (1)) a(v) JOIN (VALUES (0), (1)) b(v) ON true
    LEFT JOIN scored s ON s.y = a.v AND s.yhat = b.v GROUP BY 1, 2"""


@query("confusion_matrix", f"WITH {SCORED} {_MATRIX}")
def _(t):
    return M.confusion_matrix(t.scored, "y", "yhat")


@query("confusion_matrix_norm", f"""
    WITH {SCORED}, m AS ({_MATRIX})
    SELECT truth, predicted, round(count / sum(count) OVER (PARTITION BY truth), 6) AS share FROM m""")
def _(t):
    return rounded(M.confusion_matrix_norm(t.scored, "y", "yhat"))


@query("confusion_matrix_norm_numpy", f"""
    WITH {SCORED}, m AS ({_MATRIX}), s AS (SELECT truth AS k, sum(count) AS total FROM m GROUP BY 1)
    SELECT truth, predicted, round(count / total, 6) AS share FROM m JOIN s ON predicted = k""")
def _(t):
    return rounded(M.confusion_matrix_norm(t.scored, "y", "yhat", numpy_broadcast=True))


@query("accuracy", f"WITH {SCORED} SELECT round(avg(CAST(y = yhat AS INTEGER)), 6) AS accuracy FROM scored")
def _(t):
    return rounded(M.accuracy(t.scored, "y", "yhat"))


def _scores_sql(top: str, bottom: str) -> str:
    all_top = " + ".join(f"sum({x})" if x[0] != "2" else f"2 * sum({x[4:]})" for x in top.split(" + "))
    all_bottom = " + ".join(f"sum({x})" if x[0] != "2" else f"2 * sum({x[4:]})" for x in bottom.split(" + "))
    return f"""
    WITH {SCORED}, k AS (
      SELECT v AS class, count(*) FILTER (y = v AND yhat = v) AS tp, count(*) FILTER (y <> v AND yhat = v) AS fp,
             count(*) FILTER (y = v AND yhat <> v) AS fn, count(*) FILTER (y = v) AS support
      FROM scored, (VALUES (0), (1)) c(v) GROUP BY 1),
    s AS (SELECT *, CASE WHEN {bottom} > 0 THEN ({top}) / ({bottom}) ELSE 0 END AS value FROM k)
    SELECT 'macro' AS average, round(avg(value), 6) AS value FROM s
    UNION ALL SELECT 'micro', round(({all_top}) / ({all_bottom}), 6) FROM s
    UNION ALL SELECT 'weighted', round(sum(value * support) / sum(support), 6) FROM s
    UNION ALL SELECT 'binary', round(CASE WHEN {bottom} > 0 THEN value ELSE 1 END, 6) FROM s WHERE class = 1
    UNION ALL SELECT 'class_' || class, round(value, 6) FROM s"""


@query("precision_scores", _scores_sql("tp", "tp + fp"))
def _(t):
    return rounded(M.precision_scores(t.scored, "y", "yhat"))


@query("recall_scores", _scores_sql("tp", "tp + fn"))
def _(t):
    return rounded(M.recall_scores(t.scored, "y", "yhat"))


@query("f1_scores", _scores_sql("2 * tp", "2 * tp + fp + fn"))
def _(t):
    return rounded(M.f1_scores(t.scored, "y", "yhat"))


_FOLDED = SCORED + ", folded AS (SELECT *, event_id % 3 AS fold FROM scored)"


@query("fold_scores", f"""
    WITH {_FOLDED}, k AS (
      SELECT fold, v AS class, count(*) FILTER (y = v AND yhat = v) AS tp, count(*) FILTER (y <> v AND yhat = v) AS fp,
             count(*) FILTER (y = v AND yhat <> v) AS fn, count(*) FILTER (y = v) AS support FROM folded, (VALUES (0), (1)) c(v) GROUP BY 1, 2),
    r AS (SELECT *, 'precision' AS metric, tp AS top, tp + fp AS bottom FROM k UNION ALL SELECT *, 'recall', tp, tp + fn FROM k
          UNION ALL SELECT *, 'f1', 2 * tp, 2 * tp + fp + fn FROM k),
    s AS (SELECT *, CASE WHEN bottom > 0 THEN top / bottom ELSE 0 END AS value FROM r)
    SELECT fold, metric, 'macro' AS average, round(avg(value), 6) AS value FROM s GROUP BY 1, 2
    UNION ALL SELECT fold, metric, 'micro', round(sum(top) / sum(bottom), 6) FROM s GROUP BY 1, 2
    UNION ALL SELECT fold, metric, 'weighted', round(sum(value * support) / sum(support), 6) FROM s GROUP BY 1, 2
    UNION ALL SELECT fold, metric, 'binary', round(CASE WHEN bottom > 0 THEN value ELSE 1 END, 6) FROM s WHERE class = 1
    UNION ALL SELECT fold, metric, 'class_' || class, round(value, 6) FROM s""")
def _(t):
    folded = t.scored.withColumn("fold", F.col("event_id") % 3)
    return rounded(M.fold_scores(folded, "y", "score", "fold"))


@query("confusion_matrix_by_fold", f"""
    WITH {_FOLDED} SELECT f.v AS fold, a.v AS truth, b.v AS predicted, count(s.event_id) AS count
    FROM (VALUES (0), (1), (2)) f(v) JOIN (VALUES (0), (1)) a(v) ON true JOIN (VALUES (0), (1)) b(v) ON true
    LEFT JOIN folded s ON s.fold = f.v AND s.y = a.v AND s.yhat = b.v GROUP BY 1, 2, 3""")
def _(t):
    return M.confusion_matrix(t.scored.withColumn("fold", (F.col("event_id") % 3).cast("int")), "y", "yhat", "fold")


# ---- models ----------------------------------------------------------------------------
# gbt_train_cv grows all trees of the default booster. Those of the other queries differ from it in their number of trees alone, so that all
# of them run within minutes; rows, features, folds, leaves, depth and trials are all there are.

_TREES = 12
_BOOSTER = {**L.DEFAULT_BOOSTER, "n_estimators": _TREES}
_LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_VECTOR_FEATURES = [f"e{i}" for i in range(64)]


def _large():
    return (F.col("l_quantity") * (1 - F.col("l_discount")) > 25).cast("int")


def _lines(t):
    """Is a line large after its discount? Two of the features decide."""
    return t.lineitem.select(
        *_LINE_FEATURES, "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate",
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), _large().alias("label"))


def _vectors(t):
    return t.embeddings.select("vec_id", (F.col("embedding")[0] + F.col("embedding")[1] > 0).cast("int").alias("label"),
                               *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])


@query("gbt_train_cv")
def _(t):
    return L.gbt_train_cv(_lines(t), _LINE_FEATURES, "label", "month", 3, L.DEFAULT_BOOSTER, scratch_path(t.spark, "model"),
                          partitions=t.spark.sparkContext.defaultParallelism)[0]


@query("gbt_train_time_cv")
def _(t):
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return L.gbt_train_time_cv(_lines(t), _LINE_FEATURES, "label", order, 5, _BOOSTER,
                               partitions=t.spark.sparkContext.defaultParallelism)


@query("gbt_train_full")
def _(t):
    lines = _lines(t)
    model = L.gbt_train_full(lines, _LINE_FEATURES, "label", _BOOSTER, scratch_path(t.spark, "model"))
    return M.auc_roc(L.score_rows(model, lines, "label"), "label", "score")


@query("gbt_predict")
def _(t):
    path = scratch_path(t.spark, "model")
    L.gbt_train_full(_vectors(t), _VECTOR_FEATURES, "label", _BOOSTER, path)
    return L.gbt_predict(path, _vectors(t), "vec_id")


@query("hyperparam_search")
def _(t):
    # All parameters are searched; few trees call for larger steps.
    space = {**L.SEARCH_SPACE, "n_estimators": ("step", 2, 6, 1), "learning_rate": ("float", 0.05, 0.3)}
    return L.hyperparam_search(_vectors(t), _VECTOR_FEATURES, "vec_id", "label", space)


@query("feature_importance")
def _(t):
    return L.feature_importance(L.gbt_train_full(_lines(t), _LINE_FEATURES, "label", _BOOSTER))


@query("feature_time_consistency")
def _(t):
    return L.feature_time_consistency(_lines(t), _LINE_FEATURES, "label", "month")


@query("svm_train_score")
def _(t):
    return L.svm_train_score(split_random(_vectors(t), "vec_id", 0.2, 7), _VECTOR_FEATURES, "label")


@query("mlp_train_score")
def _(t):
    split = split_stratified(_vectors(t), "vec_id", "label", 0.33, 7)
    return L.mlp_train_score(split, _VECTOR_FEATURES, "label")


@query("submission", """
    SELECT d.doc_id, CAST(l.quality * 0.5 + l.toxic * 0.25 AS DOUBLE) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def _(t):
    template = t.documents.select("doc_id", F.lit(0.5).alias("quality"))
    predictions = t.labels.select("doc_id", (F.col("quality") * 0.5 + F.col("toxic") * 0.25).alias("score"))
    path = L.submission(template, predictions, "doc_id", "quality", "score", scratch_path(t.spark, "submission"))
    return csv_scan_typed(t.spark, path, "doc_id bigint, quality double")


# ---- whole flows ----------------------------------------------------------------------


def order_flow(t):
    """(flow, orders, what is known about their returned lines)."""
    start = F.unix_timestamp(F.lit("1995-01-01"), "yyyy-MM-dd")
    transactions = t.orders.select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.unix_timestamp("o_orderdate") - start).alias("seconds"), F.col("o_totalprice").alias("amount"),
        (F.col("o_totalprice") * 1.1).alias("amount_taxed"), F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("customer"))
    returned = t.lineitem.filter("l_returnflag = 'R'")
    identity = returned.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("returned"),
        F.sum(F.when(F.col("l_linenumber") == 7, F.col("l_tax"))).alias("last_tax"))
    flow = Preparation("o_orderkey", "label", "seconds", "1995-01-01", 1995, rare={"customer": 10},
                       crosses=[("priority", "customer")])
    return flow, transactions, identity


def prepared_orders(t):
    """Orders joined with what is known about their returned lines, prepared for training."""
    flow, transactions, identity = order_flow(t)
    return flow.prepare(transactions, identity)


@query("prepared_features", """
    WITH i AS (SELECT l_orderkey, sum(l_quantity) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    r AS (SELECT o_orderkey, o_orderdate, CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice AS amount,
                 o_orderpriority AS priority, i.returned,
                 CASE WHEN count(*) OVER (PARTITION BY o_custkey) < 10 THEN 'others' ELSE CAST(o_custkey AS VARCHAR) END AS customer
          FROM orders LEFT JOIN i ON o_orderkey = l_orderkey)
    SELECT o_orderkey, label, CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01') AS DOUBLE) AS seconds, amount,
           round(coalesce(returned, avg(returned) OVER ()), 6) AS returned,
           CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS "DT_M",
           dense_rank() OVER (ORDER BY priority) - 1 AS priority, dense_rank() OVER (ORDER BY customer) - 1 AS customer,
           dense_rank() OVER (ORDER BY priority || '_' || customer) - 1 AS priority_customer FROM r""")
def _(t):
    return rounded(prepared_orders(t))


@query("scored_submission")
def _(t):
    """Orders up to the middle of 1998 are learned from, later ones are scored."""
    prepared = prepared_orders(t)
    known = prepared.filter(F.col("DT_M") <= 42)
    unknown = prepared.filter(F.col("DT_M") > 42)
    names = ["seconds", "amount", "returned", "DT_M", "priority", "customer", "priority_customer"]
    template = unknown.select("o_orderkey", F.lit(0.5).alias("label"))
    _, _, path = train_and_submit(known, unknown, template, names, "o_orderkey", "label", "DT_M", "under", _BOOSTER)
    return csv_scan_typed(t.spark, path, "o_orderkey bigint, label double")


@query("prepared_test_features", """
    WITH i AS (SELECT l_orderkey, sum(l_quantity) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    j AS (SELECT o_orderkey, o_orderdate, o_totalprice AS amount, o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer, i.returned,
                 o_orderdate < TIMESTAMP '1998-07-01' AS early FROM orders LEFT JOIN i ON o_orderkey = l_orderkey),
    k AS (SELECT customer FROM j WHERE early GROUP BY 1 HAVING count(*) >= 10),
    r AS (SELECT j.* EXCLUDE (customer), CASE WHEN customer IN (FROM k) THEN customer ELSE 'others' END AS customer FROM j),
    p AS (SELECT priority, row_number() OVER (ORDER BY priority) - 1 AS code FROM r WHERE early GROUP BY 1),
    c AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS code FROM r WHERE early GROUP BY 1),
    pc AS (SELECT priority || '_' || customer AS pair, row_number() OVER (ORDER BY priority || '_' || customer) - 1 AS code FROM r WHERE early GROUP BY 1)
    SELECT o_orderkey, CAST(epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01') AS DOUBLE) AS seconds, amount,
           round(coalesce(returned, (SELECT avg(returned) FROM r WHERE early)), 6) AS returned,
           CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS "DT_M",
           p.code AS priority, c.code AS customer, pc.code AS priority_customer
    FROM r LEFT JOIN p ON r.priority = p.priority LEFT JOIN c ON r.customer = c.customer LEFT JOIN pc ON r.priority || '_' || r.customer = pair
    WHERE NOT early""")
def _(t):
    """Late orders, prepared by what the early ones taught: columns, frequent customers, means and codes."""
    flow, transactions, identity = order_flow(t)
    early = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp")
    dated = transactions.join(t.orders.select("o_orderkey", "o_orderdate"), "o_orderkey")
    fitted = flow.fit(dated.filter(early).drop("o_orderdate"), identity)
    return rounded(fitted.transform(dated.filter(~early).drop("o_orderdate", "label"), identity))


@query("time_split_evaluation")
def _(t):
    lines = t.lineitem.select(
        *[F.col(c) for c in t.lineitem.columns if c != "l_extendedprice"],
        _large().alias("label"))
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return evaluate_over_time(lines, "l_orderkey", "label", "l_shipdate", order, 5, _BOOSTER)


@query("feature_consistency_report")
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_quantity", "l_tax", "l_shipdate", _large().alias("label"),
        F.when(F.col("l_returnflag") == "A", F.col("l_discount")).alias("l_discount"))
    return consistent_features(lines, "l_orderkey", "label", "l_shipdate")
