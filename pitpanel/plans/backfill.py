"""Backfill: resolve a range of sessions, collect and publish it, report one outcome."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.functions.scalars import date_of
from pitpanel.functions.stages import stage
from pitpanel.operators import catalog as CA
from pitpanel.operators import normalize as N
from pitpanel.operators.calendar import non_trading_weekdays, resolve_sessions
from pitpanel.plans.daily import Landed, build_data_reference, collect_and_publish
from pitpanel.sources.store import Store

# What stored reference rows must have to be used again.
REUSABLE = {
    "universe": ("as_of_date", "thscode", "security_name", "security_name_in_time"),
    "security_reference": (
        "as_of_date", "thscode", "listing_date", "total_shares", "float_a_shares",
    ),
}


def dates_to_collect(store: Store, dates: DataFrame) -> DataFrame:
    """The dates whose universe or reference isn't stored in a reusable form."""
    stored = [store.read(name) for name in REUSABLE]
    if any(df is None for df in stored):
        return dates.select("trade_date").distinct()
    return CA.missing_partitions(dates, *stored, columns=list(REUSABLE.values()))


def with_stored(store: Store, landed: Landed, dates: DataFrame) -> Landed:
    """The feeds, with the stored universe and reference for dates they don't hold."""
    missing = dates_to_collect(store, dates)
    reusable = F.broadcast(dates.join(missing, "trade_date", "left_anti").select(
        F.col("trade_date").alias("as_of_date")
    ))

    def filled(df: DataFrame, name: str) -> DataFrame:
        stored = store.read(name)
        if stored is None:
            return df
        columns = [c for c in stored.columns if c in df.columns]
        own = df.select(date_of(df, "as_of_date").alias("as_of_date")).distinct()
        rows = stored.join(reusable, "as_of_date", "left_semi").join(own, "as_of_date", "left_anti")
        texts = [F.col(c).cast(df.schema[c].dataType).alias(c) for c in columns]
        return df.unionByName(rows.select(*texts), allowMissingColumns=True)

    return Landed(
        filled(landed.universe, "universe"),
        filled(landed.security_reference, "security_reference"),
        landed.quotes, landed.calendar,
    )


def run_backfill(
    spark: SparkSession,
    store: Store,
    landed: Landed,
    end: dt.date,
    now: dt.datetime,
    sessions: int | None = None,
    start: dt.date | None = None,
    derive: bool = True,
    min_adt20: float | None = None,
    **options,
) -> DataFrame:
    """Publish the last ``sessions`` open dates up to ``end``, or those since ``start``.

    Nothing is published from the first failing date on. The derived data is built
    once, for the newest date of the range. Returns, and appends to
    ``backfill_status``, one row: state, first failing date, completed dates, the
    weekdays without a session and the last valid date.
    """
    calendar = N.normalize_trade_calendar(landed.calendar)
    chosen = stage(resolve_sessions(calendar, end, sessions, start), "sessions")
    # One entry per session of the range.
    dates = sorted(row[0] for row in chosen.collect())
    built = {} if min_adt20 is None else {"min_adt20": min_adt20}
    status = collect_and_publish(
        spark, store, with_stored(store, landed, chosen), dates, now, stop_at_failure=True,
        derive=partial(_derive, store, now, built) if derive else None, **options,
    )
    closed = non_trading_weekdays(calendar, start or dates[0], end).agg(
        F.array_sort(F.collect_list("trade_date")).alias("non_trading_dates")
    )
    outcome = CA.backfill_state(
        status.withColumnRenamed("requested_trade_date", "trade_date")
    ).crossJoin(closed).select(
        "state", (F.col("state") == "success_backfill").alias("data_fresh"), "failed_date",
        "completed_trade_dates", "completed_count", "non_trading_dates",
        F.lit(start or dates[0]).alias("requested_start"), F.lit(end).alias("requested_end"),
        F.lit(store.latest_date()).cast("date").alias("last_valid_trade_date"),
        F.lit(now).cast("timestamp").alias("completed_at"),
    )
    outcome = stage(outcome, "backfill")
    store.append("backfill_status", outcome)
    return outcome


def _derive(store: Store, now: dt.datetime, options: dict, day: dt.date) -> DataFrame:
    return build_data_reference(store, now, day, day, **options)
