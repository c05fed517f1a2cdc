"""A wide table of yearly figures, as text, one row per entity and line item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..columns import col


def yearly_revenue(df: DataFrame, key: str, ts: str, amount: str, years: Sequence[int]) -> DataFrame:
    """(symbol, item, y<year>...): 'Total Revenue' and 'Order Count' with thousands separators."""
    in_year = F.year(col(ts))
    totals = df.groupBy(col(key).alias("symbol")).agg(
        *[F.sum(F.when(in_year == y, col(amount))).alias(f"revenue_{y}") for y in years],
        *[F.count_if(in_year == y).alias(f"count_{y}") for y in years])
    items = F.array(
        F.struct(F.lit("Total Revenue").alias("item"), *[F.format_number(f"revenue_{y}", 2).alias(f"y{y}") for y in years]),
        F.struct(F.lit("Order Count").alias("item"), *[F.format_number(f"count_{y}", 0).alias(f"y{y}") for y in years]))
    return totals.select("symbol", F.inline(items))
