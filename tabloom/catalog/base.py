"""Registration of queries, the input tables, and the role stand-ins that many queries share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        # Wall-clock timestamps and epoch seconds meet in several queries: one time zone for all.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def cases(self) -> DataFrame:
        """documents with their labels where there are any: more than half have none."""
        return self.documents.select("doc_id", "lang", "source", "n_chars").join(self.marks, "doc_id", "left")

    @property
    def marks(self) -> DataFrame:
        """labels as doubles, which is what a column with missing values is read as."""
        return self.labels.select("doc_id", F.col("quality").cast("double").alias("quality"),
                                  F.col("toxic").cast("double").alias("toxic"))

    @property
    def readings(self) -> DataFrame:
        """events in which an error carries no value."""
        return self.events.select(
            "event_id", "user_id", "event_type",
            F.when(F.col("event_type") != "error", F.col("value")).alias("value"))

    @property
    def scored(self) -> DataFrame:
        """events with a truth (is it an error?), a score and the decision it implies."""
        score = F.least(F.col("value") / 100.0, F.lit(1.0))
        return self.events.select(
            "event_id", (F.col("event_type") == "error").cast("int").alias("y"), score.alias("score"),
            F.bround(score, 0).cast("int").alias("yhat"))

    @property
    def offsets(self) -> DataFrame:
        """events with the seconds since 2024-01-01 in place of a timestamp."""
        start = F.unix_timestamp(F.lit("2024-01-01"), "yyyy-MM-dd")
        return self.events.select(
            "event_id", "user_id", "event_type", "value", (F.unix_timestamp("ts") - start).alias("seconds"))


CASES = """cases AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
READINGS = """readings AS (
  SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"""
SCORED = """scored AS (
  SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS y, least(value / 100.0, 1.0) AS score,
         CAST(round_even(least(value / 100.0, 1.0), 0) AS INTEGER) AS yhat FROM events)"""
OFFSETS = """offsets AS (
  SELECT event_id, user_id, event_type, value,
         CAST(epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-01') AS BIGINT) AS seconds FROM events)"""


def query(key: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its SQL form."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[key] = dedent(sql).strip()
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6, names: Sequence[str] | None = None) -> DataFrame:
    """Round the double columns, so that the order of additions does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: F.round(col(n), digits) for n in (names or doubles)})
