"""Adjustment factors: derivation, point-in-time versions, adjusted prices.

For an output date the whole lookback uses the factors known by that date's
cutoff. Factor versions are kept per (date, code) as a short ascending list of
(decision date, factor), so one row answers for every output date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.keys import latest_per_key, unique_or_fail
from pitpanel.functions.scalars import date_of, double_of
from pitpanel.functions.windows import scope
from pitpanel.operators.normalize import normalize_adjustments
from pitpanel.operators.temporal import LAST_DAY
from pitpanel.schemas import QUOTE_MEASURES

VERSIONS = "array<struct<decision_date: date, adj_factor: double>>"


def derive_factors(
    raw: DataFrame,
    adjusted: DataFrame,
    known_at: Column,
    method: str,
    provider: str,
    endpoint: str,
) -> DataFrame:
    """Factor = forward-adjusted close over raw close, where both are positive."""
    left = raw.select("trade_date", "thscode", F.col("close").alias("raw_close"))
    right = adjusted.select(
        "trade_date", "thscode", F.col("close").alias("forward_adj_close")
    )
    keys = ["trade_date", "thscode"]
    left, right = unique_or_fail(left, keys, "raw closes"), unique_or_fail(right, keys, "adjusted closes")
    both = left.join(right, keys, "inner").where(
        "raw_close > 0 AND forward_adj_close > 0"
    )
    return both.select(
        "trade_date", "thscode", "raw_close", "forward_adj_close",
        (F.col("forward_adj_close") / F.col("raw_close")).alias("adj_factor"),
        F.col("trade_date").alias("effective_at"),
        F.lit(None).cast("timestamp").alias("published_at"),
        known_at.alias("known_at"),
        F.lit(method).alias("adjustment_method"),
        F.lit(provider).alias("source_provider"),
        F.lit(endpoint).alias("source_endpoint"),
    )


def factor_versions(
    adjustments: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Usable factor versions per (date, code) for output dates in a range.

    Versions first usable between the same two output dates collapse to the one
    known last, and a version that changes nothing is left out, so a key keeps at
    most one version per day of the range. Factors with ``seen_from`` and ``seen_to``
    are usable only on those dates: behind them stands a version without a factor,
    unless the next snapshot has one for the key.
    """
    factors = normalize_adjustments(adjustments, parts).where("known_us IS NOT NULL")
    seen = {"seen_from", "seen_to"} <= set(factors.columns)
    floor = [F.col("decision_date"), F.col("trade_date")]
    if start is not None:
        floor.append(F.lit(start))
    if seen:
        floor.append(F.col("seen_from"))
    first = F.greatest(*floor)
    if seen:
        factors = factors.where(first <= F.col("seen_to"))
    found = factors.select(
        "trade_date", "thscode", "adj_factor", F.lit(1).alias("_found"), "known_us",
        first.alias("decision_date"),
    )
    if seen:
        ends = factors.where(F.col("seen_to") < F.lit(LAST_DAY)).select(
            "trade_date", "thscode", F.date_add("seen_to", 1).alias("decision_date")
        ).distinct()
        found = found.unionByName(ends.withColumn("_found", F.lit(0)), allowMissingColumns=True)
    if end is not None:
        found = found.where(F.col("decision_date") <= F.lit(end))
    latest = latest_per_key(
        found, ["trade_date", "thscode", "decision_date"], ["_found", "known_us"]
    )
    version = F.struct("decision_date", "adj_factor")
    listed = latest.groupBy("trade_date", "thscode").agg(
        F.array_sort(F.collect_list(version)).alias("versions")
    )
    changes = F.expr(
        "filter(versions, (v, i) -> NOT (i > 0 AND v.adj_factor <=> versions[i - 1].adj_factor))"
    )
    return listed.withColumn("versions", changes)


def factor_known(versions: Column, date: Column) -> Column:
    """The factor of a row as known on ``date``; null when none was known yet."""
    usable = F.filter(versions, lambda v: v["decision_date"] <= date)
    return F.get(usable, F.size(usable) - 1)["adj_factor"]


def known_factors(adjustments: DataFrame, date: dt.date | None = None) -> DataFrame:
    """Latest known factor per (date, code): by one cutoff, or by each own date."""
    factors = normalize_adjustments(adjustments)
    day = F.col("trade_date") if date is None else F.lit(date)
    known = factors.where(F.col("decision_date") <= day).select(
        "trade_date", "thscode", "adj_factor", "known_us"
    )
    return latest_per_key(known, ["trade_date", "thscode"], ["known_us"]).drop(
        "known_us"
    )


def clean_history(history: DataFrame) -> DataFrame:
    """Typed history, one row per (date, code)."""
    have = set(history.columns)
    typed = history.withColumns({
        "trade_date": date_of(history, "trade_date"),
        "thscode": F.upper(F.trim("thscode")),
        **{m: double_of(m) for m in QUOTE_MEASURES if m in have},
        **{m: F.lit(None).cast("double") for m in QUOTE_MEASURES if m not in have},
    })
    return latest_per_key(typed, ["trade_date", "thscode"])


def apply_adjustments(
    history: DataFrame, adjustments: DataFrame, date: dt.date | None = None
) -> DataFrame:
    """Adjusted close and return index for one vintage of factors.

    With ``date`` every row uses the factors known by that date's cutoff. Without
    it each row uses its own date's cutoff.
    """
    factors = known_factors(adjustments, date)
    out = history.join(factors, ["trade_date", "thscode"], "left")
    adjusted = F.col("close") * F.col("adj_factor")
    out = out.withColumns({
        "raw_close": F.col("close"),
        "adjusted_close": adjusted,
        "forward_adj_close": adjusted,
        "adjusted_ready": adjusted.isNotNull(),
    })
    base = F.first("adjusted_close", ignorenulls=True).over(scope(None, "trade_date"))
    return out.withColumn(
        "total_return_index", F.try_divide(F.col("adjusted_close"), base) * 100
    )
