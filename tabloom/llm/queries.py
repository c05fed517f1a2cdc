"""The operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    attention,
    filter_audit,
    importance,
    jaccard,
    language,
    licenses,
    neighbours,
    packing,
    piecewise,
    sentences,
    toxicity,
    warc,
    wavelet,
)
from .common import id_bucket, stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return register


def tokenizer(name: str) -> str:
    """The file of a public tokenizer, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_wavelet")
def op2_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, written to wavelet shards and read back."""
    found = wavelet.token_round_trip(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    list_sum(list_transform(range(0, 5), lambda b: (((strpos('0123456789abcdef', substr(hex, 1 + (5 * k + b) // 4, 1)) - 1)
      >> (3 - (5 * k + b) % 4)) & 1) << (4 - b))) AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM m""")
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archive every page in seekable bundles and list what the bundles hold."""
    found = warc.warc_round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_language")
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, folder, "documents")
    model = language.fit_languages(docs, id_bucket("doc_id", 4) != 2)
    found = language.predict_language(docs, model, ["doc_id"])
    return found.select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of 2048 ids."""
    docs = table(spark, folder, "documents")
    pieces = packing.document_pieces(docs, tokenizer("byte_bpe_50k.json"))
    pieces = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.assign_sequences(pieces)


@query("op6_piecewise")
def op6_piecewise(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return piecewise.fingerprint_documents(table(spark, folder, "documents"))


@query("op7_prefix_tree", """
WITH RECURSIVE t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
w AS (SELECT doc_id, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
b AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b FROM b JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT p.b, r.other FROM r JOIN p ON r.doc_id = p.a),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1)
SELECT m.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM m LEFT JOIN n ON m.doc_id = n.doc_id""")
def op7_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose five-word shingles are at least three quarters the same."""
    return jaccard.ngram_components(table(spark, folder, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents")
    texts, marks = toxicity.labelled_sample(docs, table(spark, folder, "labels"), id_bucket("doc_id", 4) != 2)
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(texts, marks), ["doc_id"])
    return found.select("doc_id", (id_bucket("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op9_attention")
def op9_attention(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document."""
    return attention.score_documents(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"))


@query("op1_descent", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
c AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.vec_id <> b.vec_id),
p AS (SELECT a, b FROM c WHERE s >= 0.95 AND isfinite(s)),
r AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT p.b, r.other FROM r JOIN p ON r.vec_id = p.a),
m AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY 1),
n AS (SELECT a, count(*) AS n FROM p GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM m LEFT JOIN n ON vec_id = a""")
def op1_descent(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate vectors, whatever their labels."""
    return neighbours.near_links(table(spark, folder, "embeddings"))


@query("op3_segmentation")
def op3_segmentation(spark: SparkSession, folder: str) -> DataFrame:
    """The two best segmentations of every document, and the text that each decodes to."""
    found = sentences.segment_documents(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))
    return found.select("doc_id", "rank", "score", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


_PLAIN_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_resampling", f"""
WITH w AS (SELECT doc_id AS id, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}') AS ws, true AS ours FROM documents
           UNION ALL SELECT item_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}'), false FROM benchmark),
i AS (SELECT id, ours, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
o AS (SELECT id, ours, ws[i] AS g FROM i UNION ALL SELECT id, ours, ws[i] || ' ' || ws[i + 1] FROM i WHERE i < len(ws)),
c AS (SELECT id, ours, g, count(*) AS n FROM o GROUP BY ALL),
d AS (SELECT g, xor(4294967295, list_reduce(list_transform(range(0, strlen(g)), lambda k:
    (strpos('0123456789ABCDEF', hex(g)[2 * k + 1]) - 1) * 16 + strpos('0123456789ABCDEF', hex(g)[2 * k + 2]) - 1),
    lambda x, y: list_reduce(range(0, 8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(x, y)),
    4294967295)) % 10000 AS bucket FROM (SELECT DISTINCT g FROM c)),
b AS (SELECT id, ours, bucket, sum(n) AS n FROM c JOIN d USING (g) GROUP BY ALL),
s AS (SELECT bucket, coalesce(sum(n) FILTER (ours), 0) AS s, coalesce(sum(n) FILTER (NOT ours), 0) AS t FROM b GROUP BY 1),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM s) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s),
f AS (SELECT id, sum(n) AS n, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE) AS weight FROM b JOIN gains USING (bucket) WHERE ours GROUP BY 1),
h AS (SELECT id, len(ws) AS words, CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT)::DOUBLE AS h FROM w WHERE ours),
r AS (SELECT id, words, coalesce(n, 0) AS n, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM h LEFT JOIN f USING (id)),
k AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, id) AS place, count(*) FILTER (words >= 20) OVER () AS fit FROM r)
SELECT id AS doc_id, CAST(n AS BIGINT) AS n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * fit // 100 THEN place END AS rank FROM k""")
def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the documents, drawn by how much their n-grams look like those of the benchmark."""
    found = importance.resample_to_target(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_filter_audit", """
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY x) AS least FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, {'A': len(ws) < 50, 'B': 100 * list_unique(ws) < 65 * len(ws),
  'C': 100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * len(x), 'D': regexp_matches(x, '[#$%&*|]'), 'E': least < w.doc_id} AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
u AS (SELECT part, good, bad, list_filter(['A', 'B', 'C', 'D', 'E'], lambda k: coalesce(CASE k WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B
  WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END, false)) AS failed FROM f),
g AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS ng, count(*) FILTER (bad) AS nb FROM u GROUP BY ALL),
o AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || k FROM o, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(k) WHERE NOT contains(filter_order, k)),
s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS k, string_split(filter_order[1:i - 1], '') AS earlier
      FROM o, range(1, 6) r(i) WHERE len(filter_order) = 5),
m AS (SELECT part, filter_order, step, k, n, ng, nb, len(failed) AS fails, list_contains(failed, k) AS hit, list_has_any(failed, earlier) AS gone FROM g, s),
c AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
  coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (hit AND fails = 1), 0) AS unique_fails,
  coalesce(sum(ng) FILTER (hit AND NOT gone), 0) AS good_lost, coalesce(sum(nb) FILTER (hit AND NOT gone), 0) AS toxic_lost FROM m GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM c""")
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What five filters remove, repeat and cost, per source, order and step."""
    return filter_audit.audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _license_sql() -> str:
    sentences = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
    phrases = ", ".join(f"('{label}', {p.split()})" for p, label in licenses.PHRASES.items())
    need, of = licenses.THRESHOLD
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}') AS ws FROM documents),
p AS (SELECT w.doc_id, v.label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1:i + len(v.words)] = v.words)) AS place
      FROM w, (VALUES {phrases}) v(label, words)),
base AS (SELECT doc_id, count(*) AS n, min(place) AS first_word, max(place) AS last_word, list_distinct(list(label)) AS labels FROM p GROUP BY 1),
t AS (SELECT label, list_distinct(regexp_extract_all({_LOWER}, '{_PLAIN_WORD}')) AS words FROM (VALUES {sentences}) v(i, label, text)),
b AS (SELECT doc_id, unnest(list_transform(range(0, greatest(0, ceil((len(ws) - {licenses.WIDTH}) / {licenses.STRIDE}::DOUBLE)::BIGINT) + 1),
      lambda i: list_distinct(ws[i * {licenses.STRIDE} + 1:i * {licenses.STRIDE} + {licenses.WIDTH}]))) AS held FROM w),
o AS (SELECT doc_id, label, len(list_intersect(held, words)) AS n, len(words) AS size FROM b, t),
met AS (SELECT doc_id, max(n / size::DOUBLE) AS score, list_distinct(list(label)) AS labels FROM o WHERE {of} * n >= {need} * size GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(met.labels, [])))), ',') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(met.score, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN met USING (doc_id)"""


@query("op13_licenses", _license_sql())
def op13_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses that every document names or quotes."""
    return licenses.scan_licenses(table(spark, folder, "documents")).drop("matches")
