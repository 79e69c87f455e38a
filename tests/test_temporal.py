import datetime as dt
import random

from pitpanel.operators import temporal as TP

BASE = dt.date(2024, 1, 1)


def day(n):
    return BASE + dt.timedelta(days=n)


def random_rows(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        start = rng.choice([None, rng.randrange(0, 60)])
        end = None if rng.random() < 0.3 else (start or 0) + rng.randrange(-3, 40)
        known = None if rng.random() < 0.05 else rng.randrange(0, 60)
        # One key holds most of the intervals.
        code = "A" if rng.random() < 0.7 else rng.choice("BCD")
        rows.append((
            code, None if start is None else day(start), None if end is None else day(end),
            None if known is None else known * 1000 + i,
            None if known is None else day(known), f"v{i}", rng.choice("xyz"),
        ))
    return rows


SCHEMA = (
    "thscode string, effective_from date, effective_to date, known_us bigint, "
    "decision_date date, value string, index_code string"
)


def active(row, d):
    _, start, end, known, decision, _, _ = row
    return (
        known is not None and decision <= d
        and (start is None or start <= d) and (end is None or end >= d)
    )


def test_winning_segments_equal_brute_force(spark):
    rows = random_rows(1, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    panel = spark.createDataFrame(
        [(c, day(n)) for c in "ABCDE" for n in range(-2, 110)], "thscode string, trade_date date"
    )
    segments = TP.winning_segments(df, ["thscode"], ["value"])
    joined = TP.join_segments(panel, segments, ["thscode"]).collect()
    assert len(joined) == 5 * 112
    for r in joined:
        live = [x for x in rows if x[0] == r["thscode"] and active(x, r["trade_date"])]
        want = max(live, key=lambda x: x[3])[5] if live else None
        assert r["value"] == want, (r, want)


def test_active_on_equals_the_segments_of_one_date(spark):
    rows = random_rows(2, 80)
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r["value"] for r in TP.active_on(df, day(30)).collect()}
    assert found == {x[5] for x in rows if active(x, day(30))}


def test_member_sets_and_counts_equal_brute_force(spark):
    rows = random_rows(3, 100)
    df = spark.createDataFrame(rows, SCHEMA)
    panel = spark.createDataFrame(
        [(c, day(n)) for c in "ABCDE" for n in range(0, 100, 3)], "thscode string, trade_date date"
    )
    for r in TP.active_index_members(df, panel).collect():
        want = sorted({
            x[6] for x in rows if x[0] == r["thscode"] and active(x, r["trade_date"])
        })
        assert r["index_memberships"] == want
    dates = panel.select("trade_date").distinct()
    for r in TP.active_index_counts(df, dates).collect():
        assert r["index_count"] == len({x[6] for x in rows if active(x, r["trade_date"])})


def test_tiles_of_an_interval_cover_each_day_once(spark):
    pairs = [(day(a), day(b)) for a, b in ((0, 0), (1, 6), (5, 40), (-30000, 50000))]
    df = spark.createDataFrame(pairs, "a date, b date")
    for first, last, tiles in df.select("a", "b", TP._covering_blocks("a", "b")).collect():
        begin = (first - TP.FIRST_DAY).days
        spans = sorted((t.block_no << t.level_no, 1 << t.level_no) for t in tiles)
        assert spans[0][0] == begin
        for (start, size), (following, _) in zip(spans, spans[1:]):
            assert start + size == following
        assert sum(spans[-1]) == (last - TP.FIRST_DAY).days + 1


def test_actions_ignore_late_knowledge(spark):
    df = spark.createDataFrame(
        [("A", "DIV", day(3), day(3)), ("A", "DIV", day(3), day(3)),
         ("A", "ADD", day(3), day(2)), ("A", "LATE", day(3), day(4))],
        "thscode string, event_type string, effective_at date, decision_date date",
    )
    rows = TP.actions_effective(df).collect()
    assert [(r["trade_date"], r["corporate_action_types"]) for r in rows] == [
        (day(3), ["ADD", "DIV"])
    ]


def test_snapshot_for_dates(spark):
    snapshots = spark.createDataFrame([(day(2),), (day(5),)], "as_of_date date")
    dates = spark.createDataFrame([(day(n),) for n in (1, 2, 4, 9)], "trade_date date")
    found = {
        r["trade_date"]: r["as_of_date"]
        for r in TP.snapshot_for_dates(dates, snapshots).collect()
    }
    assert found == {day(1): None, day(2): day(2), day(4): day(2), day(9): day(5)}
