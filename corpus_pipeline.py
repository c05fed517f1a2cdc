"""From raw documents to packed training sequences: toxicity, language, near duplicates, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import jaccard, language, packing, toxicity
from tabloom.llm.common import id_bucket, stored, table
from tabloom.llm.queries import tokenizer

LANGUAGE_SURE = 0.5
_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered_extras(docs: DataFrame) -> DataFrame:
    """docs with columns beyond those of documents under names that no operator adds."""
    return docs.toDF(*[c if c in _COLUMNS else f"extra_{i}" for i, c in enumerate(docs.columns)])


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that the network, fitted on the labelled rows that are not held out, predicts as toxic. Every row is
    judged by its own text, a missing one as empty; repeated rows share their fate, and an empty table stays empty."""
    rows = _numbered_extras(docs)
    texts, marks = toxicity.labelled_sample(rows, table(spark, sf_dir, "labels"), id_bucket("doc_id", 4) != 2)
    scored = toxicity.score_toxicity(rows, toxicity.fit_toxicity(texts, marks))
    return scored.filter("predicted = 0").select(*rows.columns).toDF(*docs.columns)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs whose language the model names with at least LANGUAGE_SURE; missing texts and those without a letter go.
    Repeated rows share their fate; without a row to learn from no language is known and all go."""
    rows = _numbered_extras(docs)
    model = language.fit_languages(rows, id_bucket("doc_id", 4) != 2)
    named = language.predict_language(rows, model)
    return named.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LANGUAGE_SURE)).select(*rows.columns).toDF(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with one row of each group of near duplicates: that with the smallest doc_id, a missing one being larger than any.

    Rows are told apart by a number of their own, so that rows that repeat a doc_id are compared like all others. A text
    without words is nobody's duplicate; of rows that repeat its doc_id and text one stays. Columns keep their names and values.
    """
    row = "row_number"
    while row in docs.columns:
        row += "_"
    # Written with their numbers: every later step sees the same ones.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard.ngram_components(numbered.select(F.col(row).alias("doc_id"), "text")).select(
        F.col("doc_id").alias("at"), "n_shingles", F.col("component_id").alias("group"))
    names = numbered.select(F.col(row).alias("at"), F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    alone = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    groups = found.join(names, "at").groupBy(
        F.when(~alone, F.col("group")).alias("g"), F.when(alone, F.col("id")).alias("i"), F.when(alone, F.col("h")).alias("t"))
    first = groups.agg(F.min(F.struct(F.col("id").isNull(), "id", "at"))["at"].alias(row))
    return numbered.join(first, row, "left_semi").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence of 2048 ids. A missing text is empty and still has its end; rows
    that repeat a doc_id are packed one by one."""
    pieces = packing.document_pieces(docs, tokenizer("byte_bpe_50k.json"))
    pieces = stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.assign_sequences(pieces)


STAGES = [("toxicity", keep_harmless), ("language", keep_known_language), ("near_duplicates", keep_one_of_each), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
