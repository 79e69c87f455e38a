"""Scalar column expressions: codes, dates, instants, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_US = 86_400_000_000
# The daily cutoff is 20:15 at +08:00, which is 12:15 UTC.
CUTOFF_UTC_US = (12 * 60 + 15) * 60 * 1_000_000
CUTOFF_SUFFIX = "T20:15:00+08:00"

# A listed code.
CODE_PATTERN = r"(?i)^\d{6}\.(SH|SZ|BJ)$"


def code_text(code: Column) -> Column:
    return F.upper(F.trim(code.cast("string")))


def is_listed_code(code: Column, pattern: str = CODE_PATTERN) -> Column:
    return F.coalesce(code.rlike(pattern), F.lit(False))


def exchange_of(code: Column) -> Column:
    suffix = F.substring_index(F.upper(code), ".", -1)
    return (
        F.when(suffix == "SH", "SSE")
        .when(suffix == "SZ", "SZSE")
        .when(suffix == "BJ", "BSE")
        .otherwise("UNKNOWN")
    )


def board_of(code: Column) -> Column:
    upper = F.upper(code)
    suffix = F.substring_index(upper, ".", -1)
    growth = upper.startswith("300") | upper.startswith("301")
    return (
        F.when(suffix == "BJ", "BSE")
        .when((suffix == "SH") & upper.startswith("688"), "STAR")
        .when((suffix == "SZ") & growth, "CHINEXT")
        .when(suffix == "SH", "SSE_MAIN")
        .when(suffix == "SZ", "SZSE_MAIN")
        .otherwise("UNKNOWN")
    )


def date_of(df: DataFrame, name: str) -> Column:
    """A date from any input type; text that is no date becomes null."""
    column = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return column
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(column)
    text = F.trim(column.cast("string"))
    compact = F.when(text.rlike(r"^\d{8}$"), text)
    return F.coalesce(
        F.try_to_date(compact, "yyyyMMdd"),
        F.to_date(text.try_cast("timestamp_ntz")),
    )


def double_of(name: str) -> Column:
    """A finite double; text that is no number, NaN and infinities become null."""
    value = F.col(name).try_cast("double")
    finite = (F.abs(value) < F.lit(float("inf"))) & ~F.isnan(value)
    return F.when(finite, value)


def instant_us(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch in UTC; values without an offset are UTC."""
    column = F.col(name)
    kind = df.schema[name].dataType
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.timestamp_diff("MICROSECOND", epoch, column.cast("timestamp_ntz"))
    text = F.trim(column.cast("string"))
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.rlike(r"\d:\d{2}")
    naive = text.try_cast("timestamp_ntz")
    return F.when(zoned, F.unix_micros(text.try_cast("timestamp"))).otherwise(
        F.timestamp_diff("MICROSECOND", epoch, naive)
    )


def first_decision_date(known_us: Column) -> Column:
    """The first date whose cutoff is not before the instant.

    ``known_at <= cutoff(d)`` holds exactly when ``first_decision_date <= d``,
    so every point-in-time test becomes a comparison of dates.
    """
    late_us = known_us - F.lit(CUTOFF_UTC_US)
    return F.date_from_unix_date(_ceil_div(late_us, DAY_US).cast("int"))


def _ceil_div(value: Column, step: int) -> Column:
    negative = -value
    floor = (negative - F.pmod(negative, F.lit(step))) / F.lit(step)
    return -F.round(floor)


def cutoff_text(trade_date: Column) -> Column:
    return F.concat(F.date_format(trade_date, "yyyy-MM-dd"), F.lit(CUTOFF_SUFFIX))


def pct(numerator: Column, denominator: Column) -> Column:
    """Percent change; null when the base is zero or either side is null."""
    return (F.try_divide(numerator, denominator) - 1) * 100


def truthy(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))
