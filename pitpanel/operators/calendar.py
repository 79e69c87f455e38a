"""Session lists, ranges and batches.

A DATE column holds at most a few million distinct values, so a list of
distinct dates has a fixed size bound whatever the fact tables hold; windows
and broadcasts over such lists rely on that bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.scalars import truthy


def distinct_dates(df: DataFrame, column: str = "trade_date") -> DataFrame:
    return (
        df.select(F.col(column).alias("trade_date"))
        .where(F.col("trade_date").isNotNull())
        .distinct()
    )


def numbered_sessions(dates: DataFrame) -> DataFrame:
    """Distinct dates with their ordinal, oldest first, starting at 1."""
    rank = F.row_number().over(Window.orderBy("trade_date"))
    return dates.select("trade_date").distinct().withColumn("session_no", rank)


def with_session_no(df: DataFrame, date: str = "trade_date") -> DataFrame:
    sessions = numbered_sessions(distinct_dates(df, date))
    sessions = sessions.withColumnRenamed("trade_date", date)
    return df.join(F.broadcast(sessions), date)


def last_sessions(dates: DataFrame, count: int) -> DataFrame:
    return dates.select("trade_date").distinct().orderBy(F.desc("trade_date")).limit(
        count
    )


def open_sessions(calendar: DataFrame, end: dt.date | None = None) -> DataFrame:
    days = calendar.where(truthy(F.col("is_open")) & F.col("trade_date").isNotNull())
    if end is not None:
        days = days.where(F.col("trade_date") <= F.lit(end))
    return days.select("trade_date").distinct()


def resolve_sessions(
    calendar: DataFrame,
    end: dt.date,
    sessions: int | None = None,
    start: dt.date | None = None,
) -> DataFrame:
    """The last ``sessions`` open dates up to ``end``, or those in a range."""
    if sessions is None and start is None:
        raise ValueError("give either a session count or a start date")
    if sessions is not None and sessions < 1:
        raise ValueError("backfill sessions must be positive")
    if start is not None and start > end:
        raise ValueError("backfill start cannot be after end")
    days = open_sessions(calendar, end)
    if sessions is None:
        chosen = days.where(F.col("trade_date") >= F.lit(start))
        if chosen.isEmpty():
            raise ValueError("backfill range contains no trading sessions")
        return chosen
    chosen = last_sessions(days, sessions)
    found = chosen.count()
    if found < sessions:
        raise RuntimeError(f"calendar has {found} sessions; {sessions} required")
    return chosen


def weekdays_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Monday-to-Friday dates of the single range held in ``bounds``."""
    days = bounds.select(
        F.explode(F.sequence(start, end)).alias("trade_date")
    )
    return days.where(F.weekday("trade_date") < 5)


def non_trading_weekdays(
    calendar: DataFrame, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Business days without an open session; the default range is the calendar's."""
    bounds = calendar.agg(
        F.coalesce(F.lit(start), F.min("trade_date")).alias("_start"),
        F.coalesce(F.lit(end), F.max("trade_date")).alias("_end"),
    ).where("_start IS NOT NULL")
    return weekdays_between(bounds, "_start", "_end").join(
        open_sessions(calendar), "trade_date", "left_anti"
    )


def market_closed(requested: DataFrame, calendar: DataFrame) -> DataFrame:
    return requested.select("trade_date").distinct().join(
        open_sessions(calendar), "trade_date", "left_anti"
    )


def session_batches(dates: DataFrame, size: int = 63) -> DataFrame:
    """Consecutive runs of ``size`` sessions for chunked re-processing."""
    numbered = numbered_sessions(dates)
    batch = F.floor((F.col("session_no") - 1) / size).cast("int")
    return numbered.select("trade_date", "session_no", batch.alias("batch_id"))
