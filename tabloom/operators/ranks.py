"""Ranks over calendar values and positions over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..columns import col, listed
from ..ordering import attach, sliced_index
from ..session import pin


def _calendar_rank(df: DataFrame, ts: str, fmt: str, name: str, start: int = 1) -> DataFrame:
    """Dense rank of a formatted date (of days or coarser). Rows are reduced to distinct days
    before anything is formatted or ranked; their number is bounded by the calendar."""
    dated = df.withColumn("_day", F.to_date(col(ts)))
    days = dated.select("_day").filter(F.col("_day").isNotNull()).distinct()
    rank = F.dense_rank().over(Window.orderBy(F.date_format("_day", fmt))) + F.lit(start - 1)
    return attach(dated, pin(days.withColumn(name, rank)), "_day", null_safe=False).drop("_day")


def dense_rank_date(df: DataFrame, ts: str, name: str = "day_rank") -> DataFrame:
    return _calendar_rank(df, ts, "yyyy-MM-dd", name)


def dense_rank_year_month(df: DataFrame, ts: str, name: str = "month_rank") -> DataFrame:
    return _calendar_rank(df, ts, "yyyy-MM", name)


def day_ordinal_offset(df: DataFrame, ts: str, offset: int = 364, name: str = "day_ordinal") -> DataFrame:
    """Running day number that continues after an offset: the first day is offset + 1."""
    return _calendar_rank(df, ts, "yyyy-MM-dd", name, offset + 1)


def label_encode_date(df: DataFrame, ts: str, fmt: str = "yyyyMMdd", name: str = "date_code") -> DataFrame:
    """0-based code of the formatted date in date order."""
    return _calendar_rank(df, ts, fmt, name, 0)


def global_row_index(df: DataFrame, order: str | Sequence[str], name: str = "row_index") -> DataFrame:
    """0-based position of each row in key order."""
    return sliced_index(df, listed(order), name)
