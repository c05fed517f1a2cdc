"""Scalar functions: Column in, Column out, all native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for a missing value once a column is turned into strings.
MISSING_TEXT = "nan"


def fn_strip_thousands(c: Column) -> Column:
    """'1,234.5' -> 1234.5; text that is no number becomes NULL."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("double")


def fn_as_string(c: Column) -> Column:
    """Text of a value, `nan` where it is missing. Floating-point numbers have plain decimals from 0.0001 up to 10^16 and an exponent
    of two digits beyond (12345678.0, 1e+16, 1.5e-05)."""
    kind = F.typeof(c)
    text, number = c.cast("string"), c.try_cast("double")
    # Shortest digits have at most 17 places: all of them fit the decimal.
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "(?<=[.][0-9]|[.][0-9]{1,19}[1-9])0+$", "")
    power = F.regexp_replace(F.regexp_replace(text, "([.]0)?E(-?)([0-9])$", "$1E$20$3"), "([.]0)?E(-?)([0-9]+)$", "e+$3")
    power = F.when(F.instr(text, "E-") > 0, F.replace(power, F.lit("e+"), F.lit("e-"))).otherwise(power)
    power = F.concat(F.regexp_extract(text, "^(-?[0-9.]+?)([.]0)?E", 1), F.regexp_extract(power, "(e[+-][0-9]+)$", 1))
    size = F.abs(number)
    written = F.when(~kind.isin("double", "float") | ~text.contains("E"), text).when((size >= 1e-4) & (size < 1e16), plain).otherwise(power)
    written = F.when(kind.isin("double", "float") & F.isnan(number), F.lit(MISSING_TEXT)).when(
        kind.isin("double", "float"), F.replace(written, F.lit("Infinity"), F.lit("inf"))).otherwise(written)
    return F.coalesce(written, F.lit(MISSING_TEXT))


def fn_concat_key(a: Column, b: Column) -> Column:
    return F.concat(fn_as_string(a), F.lit("_"), fn_as_string(b))


def fn_zfill_year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def fn_replace_token(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def fn_epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def fn_start_plus_seconds(seconds: Column, start: str) -> Column:
    """Start date ('yyyy-MM-dd', session time zone) plus a number of seconds."""
    return F.timestamp_add("SECOND", seconds.cast("bigint"), F.to_timestamp(F.lit(start), "yyyy-MM-dd"))


def fn_date_format(ts: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(ts, fmt)


def fn_month_index(ts: Column, base_year: int = 2017) -> Column:
    """Months counted from the January of the base year, which is 1."""
    return (F.year(ts) - base_year) * 12 + F.month(ts)


def fn_log10_shift(c: Column, minimum: float) -> Column:
    """log10(x + 1 - min(0, minimum)): defined for every x >= minimum."""
    return F.log10(c + F.lit(1.0 - min(0.0, float(minimum))))


def fn_abs(c: Column) -> Column:
    return F.abs(c)


def fn_round_even(c: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(c, digits)
