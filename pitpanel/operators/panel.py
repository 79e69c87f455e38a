"""Per-code history windows for a whole range of output dates.

Each output date sees only the rows of its last ``sessions`` market sessions,
adjusted with the factors known by its own cutoff, exactly as if the panel had
been built for that date alone.

Most factors are settled a few days after their own date. Where this holds for all
factors of a code, rows more than ``RECENT`` rows back have their last factor whatever
the date; plain windows measure them, and only the last few rows are resolved at the
date's cutoff. A code with later changes gathers its rows so far and resolves the factors of
those that a measure looks at.
What looks back without a bound there, the first row that has a factor by then, is a
running minimum over the days on which factors become usable. Gathered rows are used
at once: no later window has to carry them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions import windows as W
from pitpanel.functions.keys import stack_join
from pitpanel.functions.scalars import pct
from pitpanel.operators.adjust import factor_known, factor_versions
from pitpanel.operators.calendar import (
    distinct_dates, numbered_sessions, with_session_no,
)

RETURN_PERIODS = (1, 3, 5, 20, 60)
# Days after which the factors of a usual code don't change any more. Rows of a code have
# dates of their own, so as many rows back everything is settled too.
RECENT = 5
VOLATILITY_ROWS = (20, 60)
# Output column of each rolling high.
HIGHS = {
    20: "distance_from_high_20_pct",
    60: "distance_from_high_60_pct",
    252: "drawdown_from_high_252_pct",
}
# Output column of each z-score source.
Z_SOURCES = {
    "turnover_ratio": "turnover_z20",
    "amount": "amount_z20",
    "volume": "volume_z20",
}


def with_versions(
    history: DataFrame,
    adjustments: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    keyed: Mapping[str, DataFrame] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """History with its factor versions and the columns of the ``keyed`` tables."""
    versions = factor_versions(adjustments, start, end, parts)
    return stack_join(
        history, {**(keyed or {}), "factors": versions}, ["thscode", "trade_date"], "history"
    )


def price_location() -> dict[str, Column]:
    """Measures of a single row; a zero base gives null."""
    close, low, high = F.col("close"), F.col("low"), F.col("high")
    return {
        "gap_pct": pct(F.col("open"), F.col("pre_close")),
        "intraday_range_pct": pct(high, low),
        "close_location": F.try_divide(close - low, high - low),
        "close_vs_avg_pct": pct(close, F.col("avg_price")),
    }


# How far the changes of a code's factors reach.
_ON_TIME, _SOON, _FAR = 0, 1, 2


def _reach(start: dt.date | None) -> Column:
    """When the row's factor stops to change, as seen by output dates from ``start`` on."""
    date = F.col("trade_date")
    settled = F.get("versions", F.size("versions") - 1)["decision_date"]
    by = F.date_add(date, RECENT)
    if start is not None:
        by = F.greatest(by, F.lit(start))
    return F.when(settled > by, _FAR).when(settled > date, _SOON).otherwise(_ON_TIME)


def _complete(values: Column) -> Column:
    return ~F.exists(values, lambda v: v.isNull())


def _tail(values: Column, n: int | Column) -> Column:
    return F.when(F.size(values) >= n, F.slice(values, -n, n))


def _lookback_returns(values: Column, n: int) -> Column:
    tail = _tail(values, n + 1)
    later, earlier = F.slice(tail, 2, n), F.slice(tail, 1, n)
    return F.zip_with(later, earlier, lambda x, y: pct(x, y))


def _with_first_usable(rows: DataFrame) -> DataFrame:
    """Add ``_first`` for codes with far changes: the earliest row with a factor by the date.

    A row can serve as base from the later of its own date and the first decision
    date of a factor of it. One pass over these days, sorted together with the rows
    that ask, keeps the earliest row so far; nothing is gathered.
    """
    known = F.filter("versions", lambda v: v["adj_factor"].isNotNull())
    usable_from = F.get(known, F.lit(0))["decision_date"]
    point = F.struct("session_no", "close", "versions")
    usable = (F.col("_reach") == _FAR) & F.col("close").isNotNull() & usable_from.isNotNull()
    event = lambda day, kind, found: F.struct(
        day.alias("day"), F.lit(kind).alias("kind"), found.alias("point")
    )
    asking = event(F.col("trade_date"), 1, F.when(F.lit(False), point))
    events = F.array_compact(F.array(asking, F.when(usable, event(usable_from, 0, point))))
    so_far = Window.partitionBy("thscode").orderBy("_event.day", "_event.kind").rowsBetween(
        Window.unboundedPreceding, 0
    )
    both = rows.withColumn("_event", F.explode(events))
    return both.withColumn("_first", F.min("_event.point").over(so_far)).where(
        "_event.kind = 1"
    ).drop("_event")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sample_deviation(values: Column, n: int) -> Column:
    """Sample deviation of a full array; a null element makes it null."""
    def spread(mean: Column) -> Column:
        squares = F.aggregate(
            values, F.lit(0.0), lambda total, v: total + (v - mean) * (v - mean)
        )
        return F.sqrt(squares / (n - 1))

    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return _once(total / n, spread)


def history_panel(
    history: DataFrame,
    adjustments: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    sessions: int | None = 252,
    dates: DataFrame | None = None,
    keyed: Mapping[str, DataFrame] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """All window columns for the output dates in ``[start, end]``.

    ``history`` must be unique per (date, code) and hold the lookback before
    ``start``; its other columns pass through, and so do those of the ``keyed`` tables,
    which hold a (date, code) once too. ``dates`` lists the market sessions when they are
    cheaper to read than from ``history``. Where history and keyed tables are dealt by
    code, ``parts`` deals the factors like them and nothing else is shuffled. Without a limit of
    ``sessions`` a factor, once known, must stay known: facts of several snapshots
    (``with_validity``) need the limit.
    """
    if sessions is None and "seen_to" in adjustments.columns:
        raise ValueError("factors of several snapshots need a limit of sessions")
    if end is not None:
        history = history.where(F.col("trade_date") <= F.lit(end))
    numbered = numbered_sessions(distinct_dates(history) if dates is None else dates)
    rows = with_versions(history, adjustments, start, end, keyed, parts).join(
        F.broadcast(numbered), "trade_date"
    )
    passed = [*history.columns, *[
        c for df in (keyed or {}).values() for c in df.columns if c not in ("trade_date", "thscode")
    ]]
    date, close = F.col("trade_date"), F.col("close")
    whole_code = W.by_code().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_reach", F.max(_reach(start)).over(whole_code))
    rows = _measures(rows, sessions)
    own = F.col("_own")
    if start is not None:
        rows = rows.where(date >= F.lit(start))
    return rows.select(
        *[c for c in passed if c not in ("raw_close",)],
        "session_no",
        close.alias("raw_close"),
        "adj_factor",
        own.alias("adjusted_close"),
        own.alias("forward_adj_close"),
        own.isNotNull().alias("adjusted_ready"),
        "total_return_index",
        *[f"return_{p}d_pct" for p in RETURN_PERIODS],
        *[f"rv{n}_pct" for n in VOLATILITY_ROWS],
        *Z_SOURCES.values(),
        *[c.alias(name) for name, c in price_location().items()],
        "turnover_change_pct", "amount_change_pct",
        *HIGHS.values(),
        "history_sessions", "history_start_date", "adt20",
    )


def _with_lookback(rows: DataFrame, sessions: int | None) -> DataFrame:
    lookback = W.scope(sessions)
    factor = factor_known(F.col("versions"), F.col("trade_date"))
    return rows.withColumns({
        "adj_factor": factor,
        "_own": F.col("close") * factor,
        "history_sessions": F.count(F.lit(1)).over(lookback).cast("int"),
        "history_start_date": F.min("trade_date").over(lookback),
    })


def _raw_measures() -> dict[str, Column]:
    """Measures that no factor enters."""
    seen = F.col("history_sessions")
    return {
        **{
            target: F.when(seen >= 20, W.rolling_z(F.col(source), 20))
            for source, target in Z_SOURCES.items()
        },
        "adt20": F.when(seen >= 20, W.rolling_mean(F.col("amount"), 20)),
        "turnover_change_pct": F.when(seen > 1, W.change_over(F.col("turnover_ratio"), 1)),
        "amount_change_pct": F.when(seen > 1, W.change_over(F.col("amount"), 1)),
    }


def _measures(rows: DataFrame, sessions: int | None) -> DataFrame:
    """Windows over settled rows with the last few resolved; far changes by gathered rows."""
    date, own, seen = F.col("trade_date"), F.col("_own"), F.col("history_sessions")
    far = F.col("_reach") == _FAR
    lookback = W.scope(sessions)
    last = F.get("versions", F.size("versions") - 1)["adj_factor"]
    if sessions is None:
        rows = _with_first_usable(rows)
    rows = _with_lookback(rows, sessions).withColumn("_final", F.col("close") * last)
    rows = rows.withColumn("_step", W.change_over(F.col("_final"), 1))
    changing = F.when(F.size("versions") > 1, F.col("versions")).otherwise(
        F.when(F.get("versions", F.lit(0))["decision_date"] > date, F.col("versions"))
    )
    point = F.struct("trade_date", "close", F.col("_final").alias("final"), changing.alias("versions"))
    resolved = lambda p: F.when(p["versions"].isNull(), p["final"]).otherwise(
        p["close"] * factor_known(p["versions"], date)
    )
    older = lambda n: W.by_code().rowsBetween(-(n - 1), -RECENT)
    measured = {
        "_recent": F.collect_list(point).over(W.last_rows(RECENT + 1)),
        "_base": F.first(
            F.when(F.col("_final").isNotNull(), F.struct("trade_date", F.col("_final").alias("final"))),
            ignorenulls=True,
        ).over(lookback),
        **{
            f"_lag{p}": F.when(
                far, F.lag("close", p).over(W.by_code())
                * factor_known(F.lag("versions", p).over(W.by_code()), date)
            ).otherwise(F.lag("_final", p).over(W.by_code()))
            for p in RETURN_PERIODS if p > RECENT
        },
        **_raw_measures(),
    }
    # Empty for all other codes; a code's list is never longer than the calendar.
    measured["_points"] = F.collect_list(F.when(far, F.struct("close", "versions"))).over(W.scope(None))
    for n in VOLATILITY_ROWS:
        step = F.col("_step")
        measured[f"_mean{n}"] = F.avg(step).over(older(n))
        measured[f"_spread{n}"] = F.when(
            F.count(step).over(older(n)) == n - RECENT, F.var_pop(step).over(older(n))
        ) * (n - RECENT)
    for n in HIGHS:
        measured[f"_high{n}"] = F.when(
            F.count("_final").over(older(n)) == n - RECENT, F.max("_final").over(older(n))
        )
    rows = rows.withColumns(measured)
    adjusted = lambda n: F.transform(
        _tail(F.col("_points"), n), lambda p: p["close"] * factor_known(p["versions"], date)
    )
    recent = F.col("_recent")
    rows = rows.withColumn("_series", F.when(
        F.col("_reach") == _ON_TIME, recent["final"]
    ).otherwise(F.transform(recent, resolved)))
    series = F.col("_series")
    back = lambda p: F.get(series, F.size(series) - 1 - p) if p <= RECENT else F.col(f"_lag{p}")
    out = {f"return_{p}d_pct": F.when(seen > p, pct(own, back(p))) for p in RETURN_PERIODS}
    # Rows of the lookback from before the first final price have none on this date either,
    # unless they are recent.
    inside = F.filter(
        F.arrays_zip(recent["trade_date"].alias("day"), series.alias("value")),
        lambda p: (p["day"] >= F.col("history_start_date")) & p["value"].isNotNull(),
    )
    base = F.when(
        F.col("_base.trade_date") <= F.date_sub(date, RECENT), F.col("_base.final")
    ).when(F.col("_reach") == _ON_TIME, F.col("_base.final")).otherwise(F.get(inside, F.lit(0))["value"])
    if sessions is None:
        far_base = F.col("_first.close") * factor_known(F.col("_first.versions"), date)
    else:
        far_base = F.get(F.filter(adjusted(seen), lambda v: v.isNotNull()), F.lit(0))
    base = F.when(far, far_base).otherwise(base)
    out["total_return_index"] = F.try_divide(own, base) * 100
    latest = F.slice(series, -RECENT, RECENT)
    whole = (F.size(series) > RECENT) & _complete(series)
    moved = F.when(whole, _lookback_returns(series, RECENT))
    rows = rows.withColumn("_moved", moved)
    total = F.aggregate("_moved", F.lit(0.0), lambda acc, v: acc + v)
    rows = rows.withColumn("_mean", total / RECENT)
    squares = F.aggregate(
        "_moved", F.lit(0.0), lambda acc, v: acc + (v - F.col("_mean")) * (v - F.col("_mean"))
    )
    rows = rows.withColumn("_spread", squares)
    for n in VOLATILITY_ROWS:
        # Two parts with means and squares of their own, put together.
        apart = F.col(f"_mean{n}") - F.col("_mean")
        spread = F.col(f"_spread{n}") + F.col("_spread") + apart * apart * (
            RECENT * (n - RECENT) / n
        )
        deviation = _once(
            _lookback_returns(adjusted(n + 1), n), lambda moved: _sample_deviation(moved, n)
        )
        out[f"rv{n}_pct"] = F.when(
            seen > n, F.when(far, deviation).otherwise(F.sqrt(spread / (n - 1))) * F.lit(W.ANNUAL)
        )
    top = F.when(whole | (F.size(series) >= RECENT) & _complete(latest), F.array_max(latest))
    rows = rows.withColumn("_top", top)
    for n, target in HIGHS.items():
        known = F.col(f"_high{n}").isNotNull() & F.col("_top").isNotNull()
        far_high = _once(
            adjusted(n), lambda tail: F.when(_complete(tail), F.array_max(tail))
        )
        high = F.when(far, far_high).otherwise(F.when(known, F.greatest(f"_high{n}", "_top")))
        out[target] = F.when(seen >= n, pct(own, high))
    return rows.withColumns(out)


def benchmark_returns(
    index_quotes: DataFrame,
    dates: DataFrame,
    codes: Sequence[str],
    sessions: int | None = 252,
) -> DataFrame:
    """20-row return of each benchmark as of each date, one column per code.

    Uses the benchmark's own last 21 non-null closes, inside the last
    ``sessions`` dates of the index table. All inputs here are date lists.
    """
    rows = with_session_no(index_quotes.select("trade_date", "thscode", "close"))
    wanted = F.array(*[F.lit(c) for c in codes])
    order = W.by_code("trade_date")
    quoted = rows.where(F.col("close").isNotNull() & F.col("thscode").isin(*codes))
    base = F.lag("close", 20).over(order)
    measured = quoted.select(
        "trade_date", "thscode",
        F.struct(
            F.when(base > 0, pct(F.col("close"), base)).alias("value"),
            F.lag("session_no", 20).over(order).alias("base_no"),
        ).alias("_measure"),
        F.lit(None).cast("int").alias("session_no"),
    )
    asked = dates.select("trade_date").distinct().select(
        "trade_date", F.explode(wanted).alias("thscode")
    )
    known = rows.select("trade_date", "session_no").distinct().select(
        "trade_date", F.explode(wanted).alias("thscode"), "session_no"
    )
    # Per benchmark: its measures, the index sessions and the dates asked for.
    timeline = (
        measured.unionByName(known, allowMissingColumns=True)
        .unionByName(asked, allowMissingColumns=True)
        .groupBy("thscode", "trade_date")
        .agg(F.max("_measure").alias("_measure"), F.max("session_no").alias("session_no"))
    )
    measure = F.last("_measure", ignorenulls=True).over(order)
    latest_no = F.last("session_no", ignorenulls=True).over(order)
    held = timeline.withColumns({"_measure": measure, "_latest_no": latest_no})
    value = F.col("_measure.value")
    if sessions is not None:
        inside = F.col("_latest_no") - F.col("_measure.base_no") < sessions
        value = F.when(inside, value)
    wide = [
        F.max(F.when(F.col("thscode") == c, F.col("_value"))).alias(c) for c in codes
    ]
    return (
        held.select("trade_date", "thscode", value.alias("_value"))
        .groupBy("trade_date").agg(*wide)
        .join(F.broadcast(dates.select("trade_date").distinct()), "trade_date", "left_semi")
    )
