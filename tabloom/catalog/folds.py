"""Splits, folds and class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling as B
from ..operators import splits as X
from .base import query, rounded

_HASH = "md5(event_id || ':7')"


def _events(t):
    return t.events.select("event_id", "event_type", (F.col("event_type") == "error").cast("int").alias("label"))


@query("split_random", f"""
    SELECT event_id, CASE WHEN row_number() OVER (ORDER BY {_HASH}) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS role
    FROM events""")
def _(t):
    return X.split_random(t.events.select("event_id"), "event_id", 0.2, 7)


@query("split_stratified", f"""
    SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY {_HASH})
           <= ceil(0.2 * count(*) OVER (PARTITION BY event_type)) THEN 'test' ELSE 'train' END AS role FROM events""")
def _(t):
    return X.split_stratified(t.events.select("event_id", "event_type"), "event_id", "event_type", 0.2, 7)


_TIME_FOLD = """
    SELECT o_orderkey, CAST(greatest(0, 5 - floor((n - 1 - i) / (n // 6))) AS INTEGER) AS fold
    FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)"""


@query("split_time_series", _TIME_FOLD)
def _(t):
    return X.split_time_series(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 5).drop("o_orderdate")


_MONTHS = "months AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders)"


def _months(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("split_group_kfold", f"""
    WITH RECURSIVE {_MONTHS},
    g AS (SELECT month, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, month DESC) AS r FROM months GROUP BY 1),
    a AS (SELECT CAST(0 AS BIGINT) AS r, CAST(NULL AS VARCHAR) AS month, -1 AS fold, CAST(0 AS BIGINT) AS l0, CAST(0 AS BIGINT) AS l1,
                 CAST(0 AS BIGINT) AS l2
          UNION ALL
          SELECT r, month, fold, l0 + CASE WHEN fold = 0 THEN n ELSE 0 END, l1 + CASE WHEN fold = 1 THEN n ELSE 0 END,
                 l2 + CASE WHEN fold = 2 THEN n ELSE 0 END
          FROM (SELECT g.r, g.month, g.n, a.l0, a.l1, a.l2,
                       CASE WHEN l0 <= l1 AND l0 <= l2 THEN 0 WHEN l1 <= l2 THEN 1 ELSE 2 END AS fold
                FROM a JOIN g ON g.r = a.r + 1))
    SELECT m.o_orderkey, m.month, CAST(a.fold AS INTEGER) AS fold FROM months m JOIN a ON m.month = a.month""")
def _(t):
    return X.split_group_kfold(_months(t), "month", 3)


@query("split_leave_one_group_out", f"""
    WITH {_MONTHS} SELECT o_orderkey, month, CAST(dense_rank() OVER (ORDER BY month) - 1 AS INTEGER) AS fold FROM months""")
def _(t):
    return X.split_leave_one_group_out(_months(t), "month")


@query("split_leave_p_groups_out", """
    WITH g AS (SELECT DISTINCT lang FROM documents)
    SELECT row_number() OVER (ORDER BY a.lang, b.lang) - 1 AS fold, a.lang || ',' || b.lang AS test_groups
    FROM g a JOIN g b ON a.lang < b.lang""")
def _(t):
    folds = X.split_leave_p_groups_out(t.documents, "lang", 2)
    return folds.withColumn("test_groups", F.array_join("test_groups", ","))


@query("leave_p_groups_out_rows", """
    WITH g AS (SELECT DISTINCT lang FROM documents),
    f AS (SELECT row_number() OVER (ORDER BY a.lang, b.lang) - 1 AS fold, a.lang AS a, b.lang AS b FROM g a JOIN g b ON a.lang < b.lang)
    SELECT doc_id, lang, fold FROM documents JOIN f ON lang = a OR lang = b""")
def _(t):
    return X.with_leave_p_groups_out(t.documents.select("doc_id", "lang"), "lang", 2)


@query("split_stratified_kfold", f"""
    WITH r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {_HASH}) - 1 AS i,
                      count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_id, event_type, CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                                           ELSE (i - n % 5) // (n // 5) END AS INTEGER) AS fold FROM r""")
def _(t):
    return X.split_stratified_kfold(t.events.select("event_id", "event_type"), "event_id", "event_type", 5, 7)


@query("fold_sizes", f"""
    WITH {_MONTHS}, f AS (SELECT month, CAST(dense_rank() OVER (ORDER BY month) - 1 AS INTEGER) AS fold FROM months),
    c AS (SELECT fold, count(*) AS rows, count(DISTINCT month) AS groups FROM f GROUP BY 1)
    SELECT fold, 'test' AS role, rows, groups FROM c
    UNION ALL SELECT fold, 'train', CAST(sum(rows) OVER () AS BIGINT) - rows, CAST(sum(groups) OVER () AS BIGINT) - groups FROM c""")
def _(t):
    return X.fold_sizes(X.split_leave_one_group_out(_months(t), "month"), "fold", "month")


@query("fold_sizes_expanding", f"""
    WITH f AS ({_TIME_FOLD}), c AS (SELECT fold, count(*) AS rows FROM f GROUP BY 1)
    SELECT fold, 'test' AS role, rows FROM c WHERE fold > 0
    UNION ALL SELECT c.fold, 'train', CAST(sum(b.rows) AS BIGINT) FROM c JOIN c b ON b.fold < c.fold GROUP BY 1""")
def _(t):
    split = X.split_time_series(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 5)
    return X.fold_sizes(split, expanding=True)


@query("shuffle_rows", f"SELECT event_id, event_type FROM events ORDER BY {_HASH}")
def _(t):
    return X.shuffle_rows(t.events.select("event_id", "event_type"), "event_id", 7)


_LABELLED = "e AS (SELECT event_id, event_type, CAST(event_type = 'error' AS INTEGER) AS label FROM events)"


@query("sample_under", f"""
    WITH {_LABELLED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_HASH}) AS i FROM e),
    m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM e GROUP BY label))
    SELECT event_id, event_type, label FROM r, m WHERE i <= n""")
def _(t):
    return B.sample_under(_events(t), "event_id", "label", 7)


@query("sample_over", f"""
    WITH {_LABELLED}, p AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM e WHERE label = 1),
    d AS (SELECT CAST('0x' || substr(md5(k || ':7'), 1, 8) AS BIGINT) % (SELECT count(*) FROM p) AS i
          FROM range((SELECT count(*) FROM e WHERE label = 0)) r(k)),
    c AS (SELECT i, count(*) AS times FROM d GROUP BY 1)
    SELECT event_id, event_type, label, CAST(1 AS INTEGER) AS copy FROM e WHERE label = 0
    UNION ALL SELECT event_id, event_type, label, CAST(unnest(range(1, times + 1)) AS INTEGER) FROM p JOIN c ON p.i = c.i""")
def _(t):
    return B.sample_over(_events(t), "event_id", "label", 7)


def _mixed(template: str) -> str:
    return ", ".join(template.format(i=i, j=i + 1) for i in range(64))


def _draw(what: str) -> str:
    return f"CAST('0x' || substr(md5(k || ':7:{what}'), 1, 8) AS BIGINT)"


@query("sample_smote", f"""
    WITH e AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    p AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, x FROM e WHERE label = 1),
    n AS (SELECT a.i, b.i AS j, row_number() OVER (PARTITION BY a.i ORDER BY list_distance(a.x, b.x), b.i) - 1 AS r
          FROM p a JOIN p b ON a.i <> b.i QUALIFY r < 5),
    d AS (SELECT {_draw("row")} % (SELECT count(*) FROM p) AS i, {_draw("neighbour")} % 5 AS r,
                 {_draw("place")} / 4294967296.0::DOUBLE AS u
          FROM range((SELECT count(*) FILTER (label = 0) - count(*) FILTER (label = 1) FROM e)) t(k))
    SELECT {_mixed("round(x[{j}], 6) AS e{i}")}, label, false AS synthetic FROM e
    UNION ALL SELECT {_mixed("round(a.x[{j}] + u * (b.x[{j}] - a.x[{j}]), 6)")}, 1, true
    FROM d JOIN n ON d.i = n.i AND d.r = n.r JOIN p a ON a.i = d.i JOIN p b ON b.i = n.j""")
def _(t):
    vectors = t.embeddings.select(
        "vec_id", (F.col("label") == 0).cast("int").alias("label"), *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])
    return rounded(B.sample_smote(vectors, [f"e{i}" for i in range(64)], "vec_id", "label", 5, 7))
