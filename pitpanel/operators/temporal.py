"""Point-in-time filters, and interval memberships as disjoint timelines.

A fact may be used on date ``d`` when its ``decision_date`` is not after ``d``
(see ``first_decision_date``). A membership interval is therefore usable from
the later of its effective start and its decision date. For many dates at once
the intervals of a key become disjoint segments first, so that each fact row
later meets exactly one segment and no pairs pile up in a group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.keys import deal, latest_per_key

# All days that a DATE holds, but for the last one: a day after an end is a date too.
FIRST_DAY = dt.date(1, 1, 1)
LAST_DAY = dt.date(9999, 12, 30)
# Days since FIRST_DAY fit in 22 bits.
_LEVELS = 22


def known_by(df: DataFrame, date: dt.date | Column) -> DataFrame:
    """Rows whose knowledge date allows use on ``date``; unknown is excluded."""
    if "decision_date" not in df.columns:
        return df.where(F.lit(False))
    day = date if isinstance(date, Column) else F.lit(date)
    return df.where(F.col("decision_date") <= day)


def active_on(df: DataFrame, date: dt.date) -> DataFrame:
    """Known intervals that cover one date; open ends are unbounded."""
    day = F.lit(date)
    return known_by(df, date).where(
        (F.coalesce("effective_from", day) <= day)
        & (F.coalesce("effective_to", day) >= day)
    )


def with_validity(df: DataFrame, start: dt.date, snapshots: DataFrame) -> DataFrame:
    """Facts of many snapshots with the dates each is the newest one for.

    ``snapshots`` lists their dates, ``df`` has ``as_of_date``. From ``start`` on, a
    date sees the newest snapshot not after it: ``seen_from`` and ``seen_to`` bound
    the dates that see a fact. Earlier snapshots than that of ``start`` are left out.
    """
    order = Window.orderBy("as_of_date")
    spans = snapshots.select("as_of_date").distinct().withColumns({
        "seen_from": F.col("as_of_date"),
        "seen_to": F.coalesce(
            F.date_sub(F.lead("as_of_date").over(order), 1), F.expr(f"DATE '{LAST_DAY}'")
        ),
    }).where(F.col("seen_to") >= F.lit(start))
    return df.join(F.broadcast(spans), "as_of_date")


def usable_intervals(df: DataFrame) -> DataFrame:
    """Add the clipped ``first_day`` and ``last_day`` of use; drop empty intervals.

    Facts with ``seen_from`` and ``seen_to`` are usable only on those dates.
    """
    low, high = F.expr(f"DATE '{FIRST_DAY}'"), F.expr(f"DATE '{LAST_DAY}'")
    seen = {"seen_from", "seen_to"} <= set(df.columns)
    first = F.greatest(
        F.coalesce("effective_from", low), "decision_date", low,
        *(["seen_from"] if seen else []),
    )
    last = F.least(F.coalesce("effective_to", high), high, *(["seen_to"] if seen else []))
    return (
        df.where(F.col("decision_date").isNotNull())
        .withColumn("first_day", first)
        .withColumn("last_day", last)
        .where("first_day <= last_day")
    )


def merged_intervals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of the usable intervals of each key as disjoint intervals.

    Only the longest interval per start is kept before the window, so a key
    has at most one row per day there.
    """
    longest = df.groupBy(*keys, "first_day").agg(F.max("last_day").alias("last_day"))
    order = Window.partitionBy(*keys).orderBy("first_day")
    reach = F.max("last_day").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first_day") > F.date_add(reach, 1), F.lit(True))
    runs = longest.withColumn("_starts", starts.cast("int")).withColumn(
        "_run", F.sum("_starts").over(order)
    )
    return runs.groupBy(*keys, "_run").agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    ).drop("_run")


def _breakpoints(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    edges = F.array("first_day", F.date_add("last_day", 1))
    return df.select(*keys, F.explode(edges).alias("day")).distinct()


def _as_segments(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    last = F.coalesce(F.date_sub(following, 1), F.expr(f"DATE '{LAST_DAY}'"))
    return points.withColumn("segment_to", last).withColumnRenamed(
        "day", "segment_from"
    )


def _covering_blocks(first: str, last: str) -> Column:
    """Aligned power-of-two blocks that exactly tile the days of an interval.

    At most two blocks per level, so at most ``2 * _LEVELS`` per interval.
    """
    begin = f"date_diff({first}, DATE '{FIRST_DAY}')"
    end = f"(date_diff({last}, DATE '{FIRST_DAY}') + 1)"
    tiles = []
    for level in range(_LEVELS):
        size = 1 << level
        left = f"(({begin} + {size - 1}) div {size})"
        right = f"({end} div {size})"
        fits = f"{left} < {right}"
        tiles.append(
            f"CASE WHEN {fits} AND {left} % 2 = 1 THEN struct({level} AS level_no, "
            f"CAST({left} AS INT) AS block_no) END"
        )
        tiles.append(
            f"CASE WHEN {fits} AND {right} % 2 = 1 THEN struct({level} AS level_no, "
            f"CAST({right} - 1 AS INT) AS block_no) END"
        )
    return F.expr(f"array_compact(array({', '.join(tiles)}))")


def _enclosing_blocks(day: str) -> Column:
    number = f"date_diff({day}, DATE '{FIRST_DAY}')"
    blocks = [
        f"struct({level} AS level_no, CAST({number} div {1 << level} AS INT) AS block_no)"
        for level in range(_LEVELS)
    ]
    return F.expr(f"array({', '.join(blocks)})")


def winning_segments(
    df: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Disjoint segments per key with the values of the latest-known interval.

    The winner among the intervals covering a day is the one known last. Each
    interval is cut into at most two aligned blocks per power of two, every
    block keeps its best interval, and a breakpoint looks only at the blocks
    around it. Work grows with the number of intervals, never with pairs.
    Output: keys, ``segment_from``, ``segment_to`` and ``values`` (null where
    nothing is active).
    """
    keys = list(keys)
    usable = usable_intervals(df)
    best = F.struct("known_us", *values)
    tiles = usable.select(
        *keys, best.alias("_best"),
        F.inline(_covering_blocks("first_day", "last_day")),
    ).groupBy(*keys, "level_no", "block_no").agg(F.max("_best").alias("_best"))
    points = _breakpoints(usable, keys)
    winners = (
        points.select(*keys, "day", F.inline(_enclosing_blocks("day")))
        .join(tiles, [*keys, "level_no", "block_no"], "left")
        .groupBy(*keys, "day")
        .agg(F.max("_best").alias("_best"))
    )
    return _as_segments(winners, keys).select(
        *keys, "segment_from", "segment_to",
        *[F.col(f"_best.{v}").alias(v) for v in values],
    )


def member_set_segments(
    df: DataFrame, owner: str, member: str, out: str
) -> DataFrame:
    """Disjoint segments per owner with the sorted set of active members.

    An event sweep: every merged interval adds its member on its first day and takes
    it away behind its last one. The events of an owner are read once in the order of
    days; a day with events gives one set, made from the one before it.
    """
    spans = merged_intervals(usable_intervals(df), [owner, member])
    event = lambda day, step: F.struct(
        day.alias("day"), F.lit(step).alias("step"), F.col(member).alias("member")
    )
    events = spans.select(owner, F.inline(F.array(
        event(F.col("first_day"), 1), event(F.date_add("last_day", 1), -1)
    )))
    # Per (owner, day): who comes and who goes; merged intervals never do both.
    changes = events.groupBy(owner, "day").agg(
        F.array_sort(F.collect_list(F.when(F.col("step") == 1, F.col("member")))).alias("come"),
        F.array_sort(F.collect_list(F.when(F.col("step") == -1, F.col("member")))).alias("go"),
    )
    ordered = changes.groupBy(owner).agg(
        F.array_sort(F.collect_list(F.struct("day", "come", "go"))).alias("_changes")
    )
    kind = df.schema[member].dataType.simpleString()
    sets = f"""aggregate(_changes, CAST(array() AS array<struct<day: date, held: array<{kind}>>>),
        (sets, e) -> array_append(sets, named_struct('day', e.day, 'held', array_sort(array_union(
            array_except(coalesce(get(sets, size(sets) - 1).held, CAST(array() AS array<{kind}>)), e.go),
            e.come)))))"""
    points = ordered.select(owner, F.inline(F.expr(sets))).withColumnRenamed("held", out)
    return _as_segments(points, [owner])


def join_segments(
    df: DataFrame, segments: DataFrame | Sequence[DataFrame], keys: Sequence[str],
    date: str = "trade_date", parts: int | None = None,
) -> DataFrame:
    """Attach the one segment of each key that covers the row's date.

    Rows and segment starts are sorted together by key and day, and each row takes
    the last start before it: no row meets more than one segment. Several timelines
    share that sort. Where the rows are dealt by a key, ``parts`` deals the starts
    like them, and the rows stay where they are.
    """
    timelines = [segments] if isinstance(segments, DataFrame) else segments
    both = df.withColumn("_kind", F.lit(1))
    for i, timeline in enumerate(timelines):
        values = [c for c in timeline.columns if c not in (*keys, "segment_from")]
        starts = timeline.dropna(subset=list(keys)).select(
            *keys, F.col("segment_from").alias(date), F.lit(0).alias("_kind"),
            F.struct(*values).alias(f"_segment{i}"),
        )
        both = both.unionByName(deal(starts, parts, keys[0]), allowMissingColumns=True)
    before = Window.partitionBy(*keys).orderBy(date, "_kind").rowsBetween(
        Window.unboundedPreceding, 0
    )
    held = both.withColumns({
        f"_segment{i}": F.last(f"_segment{i}", ignorenulls=True).over(before)
        for i in range(len(timelines))
    })
    found = [
        F.when(F.col(f"_segment{i}.segment_to") >= F.col(date), F.col(f"_segment{i}.{v}")).alias(v)
        for i, timeline in enumerate(timelines)
        for v in timeline.columns if v not in (*keys, "segment_from", "segment_to")
    ]
    return held.where("_kind = 1").select(*df.columns, *found)


def industry_segments(membership: DataFrame, level: str, prefix: str) -> DataFrame:
    """Timeline of one classification level per code."""
    rows = membership.where(
        (F.upper("classification_system") == "SW") & (F.col("level") == level)
    ).select(
        "thscode", "effective_from", "effective_to", "known_us", "decision_date",
        *[c for c in ("seen_from", "seen_to") if c in membership.columns],
        F.col("industry_code").alias(f"{prefix}_code"),
        F.col("industry_name").alias(f"{prefix}_name"),
    )
    return winning_segments(rows, ["thscode"], [f"{prefix}_code", f"{prefix}_name"])


def active_industry(membership: DataFrame, dates: DataFrame) -> DataFrame:
    """Latest-known active classification per (date, code, level)."""
    rows = membership.where(F.upper("classification_system") == "SW")
    segments = winning_segments(
        rows, ["thscode", "level"], ["industry_code", "industry_name"]
    )
    levels = segments.select("thscode", "level").distinct()
    return join_segments(
        dates.join(levels, "thscode"), segments, ["thscode", "level"]
    ).where(F.col("industry_code").isNotNull())


def active_index_members(
    membership: DataFrame, panel: DataFrame, out: str = "index_memberships"
) -> DataFrame:
    """Sorted array of index codes per (date, code); empty when none is active."""
    segments = member_set_segments(membership, "thscode", "index_code", out)
    joined = join_segments(panel, segments, ["thscode"])
    return joined.withColumn(
        out, F.coalesce(out, F.array().cast("array<string>"))
    )


def active_index_counts(membership: DataFrame, dates: DataFrame) -> DataFrame:
    """Number of distinct indexes with an active member, per date."""
    spans = merged_intervals(usable_intervals(membership), ["index_code"])
    steps = spans.select(
        F.inline(F.array(
            F.struct(F.col("first_day").alias("trade_date"), F.lit(1).alias("_step")),
            F.struct(
                F.date_add("last_day", 1).alias("trade_date"), F.lit(-1).alias("_step")
            ),
        ))
    )
    daily = (
        steps.unionByName(
            dates.select("trade_date").distinct().withColumn("_step", F.lit(0))
        )
        .groupBy("trade_date")
        .agg(F.sum("_step").alias("_step"))
    )
    count = F.sum("_step").over(Window.orderBy("trade_date"))
    return daily.withColumn("index_count", count).join(
        F.broadcast(dates.select("trade_date").distinct()), "trade_date", "left_semi"
    ).select("trade_date", "index_count")


def actions_effective(actions: DataFrame) -> DataFrame:
    """Known action types per (effective date, code), as a sorted set.

    Actions with ``seen_from`` and ``seen_to`` count only on those dates.
    """
    if {"seen_from", "seen_to"} <= set(actions.columns):
        actions = actions.where(F.col("effective_at").between(F.col("seen_from"), F.col("seen_to")))
    known = actions.where(
        (F.col("decision_date") <= F.col("effective_at"))
        & F.col("event_type").isNotNull()
    )
    return (
        known.select(F.col("effective_at").alias("trade_date"), "thscode", "event_type")
        .distinct()
        .groupBy("trade_date", "thscode")
        .agg(F.array_sort(F.collect_list("event_type")).alias("corporate_action_types"))
    )


def provider_flags_as_of(provider: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest provider row known by the cutoff of its own date."""
    known = provider.where(F.col("decision_date") <= F.col("as_of_date")).select(
        F.col("as_of_date").alias("trade_date"), "thscode", "known_us", *columns
    )
    return latest_per_key(known, ["trade_date", "thscode"], ["known_us"]).drop(
        "known_us"
    )


def snapshot_for_dates(dates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Newest ``as_of_date`` not after each date; both sides are date lists."""
    marks = snapshots.select(
        F.col("as_of_date").alias("trade_date"), "as_of_date"
    ).distinct()
    order = Window.orderBy("trade_date")
    held = (
        marks.unionByName(dates.select("trade_date"), allowMissingColumns=True)
        .groupBy("trade_date")
        .agg(F.max("as_of_date").alias("as_of_date"))
        .withColumn("as_of_date", F.last("as_of_date", ignorenulls=True).over(order))
    )
    return held.join(
        F.broadcast(dates.select("trade_date").distinct()), "trade_date", "left_semi"
    )
