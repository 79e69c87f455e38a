import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pitpanel.operators.adjust import apply_adjustments, factor_versions
from pitpanel.operators.panel import RECENT, benchmark_returns, history_panel

BASE = dt.date(2024, 1, 1)
FIELDS = (
    "return_1d_pct", "return_5d_pct", "return_20d_pct", "rv20_pct", "total_return_index",
    "distance_from_high_20_pct", "volume_z20", "adt20", "amount_change_pct",
)


def day(n):
    return BASE + dt.timedelta(days=n)


def market(seed, days=70, delay=900):
    """Prices with gaps, and factors known on time, late, revised or never."""
    rng = random.Random(seed)
    bars, factors = [], []
    for code in ("CLEAN", "LATE", "GAPPY"):
        for n in range(days):
            if code == "GAPPY" and rng.random() < 0.25:
                continue
            close = None if code == "GAPPY" and rng.random() < 0.03 else rng.uniform(5, 50)
            bars.append((day(n), code, close, rng.uniform(1, 9), rng.uniform(100, 900)))
            stamp = dt.datetime.combine(day(n), dt.time(10))
            factors.append((day(n), code, rng.choice([0.5, 1.0]), stamp))
            if code == "LATE" and rng.random() < 0.4:
                late = stamp + dt.timedelta(hours=rng.randrange(1, delay))
                factors.append((day(n), code, rng.uniform(0.2, 2.0), late))
    return bars, factors


def frames(spark, bars, factors):
    history = spark.createDataFrame(
        bars, "trade_date date, thscode string, close double, volume double, amount double"
    ).withColumns({c: F.lit(1.0) for c in ("open", "high", "low", "pre_close", "avg_price")})
    history = history.withColumns({"turnover_ratio": F.col("volume"), "change_ratio": F.lit(0.0)})
    adjustments = spark.createDataFrame(
        factors, "trade_date date, thscode string, adj_factor double, known_at timestamp"
    )
    return history, adjustments


def expected(bars, factors, code, d, sessions):
    """One output row by definition, from the facts known at its cutoff."""
    dates = sorted({b[0] for b in bars if b[0] <= d})[-sessions:]
    rows = sorted((b for b in bars if b[1] == code and dates[0] <= b[0] <= d))
    cutoff = dt.datetime.combine(d, dt.time(12, 15))
    adjusted = []
    for t, _, close, _, _ in rows:
        known = [f for f in factors if f[0] == t and f[1] == code and f[3] <= cutoff]
        factor = max(known, key=lambda f: f[3])[2] if known else None
        adjusted.append(None if close is None or factor is None else close * factor)

    def change(values, p):
        if len(values) <= p or values[-1] is None or values[-1 - p] is None:
            return None
        return (values[-1] / values[-1 - p] - 1) * 100

    def last(values, n):
        tail = values[-n:]
        return tail if len(tail) == n and None not in tail else None

    steps = [None] + [change(adjusted[: i + 1], 1) for i in range(1, len(adjusted))]
    moves, highs = last(steps, 20), last(adjusted, 20)
    volumes, amounts = [b[3] for b in rows], [b[4] for b in rows]
    base = next((a for a in adjusted if a is not None), None)
    out = {f"return_{p}d_pct": change(adjusted, p) for p in (1, 5, 20)}
    out["rv20_pct"] = statistics.stdev(moves) * math.sqrt(252) if moves else None
    out["total_return_index"] = (
        adjusted[-1] / base * 100 if base and adjusted[-1] is not None else None
    )
    out["distance_from_high_20_pct"] = (
        (adjusted[-1] / max(highs) - 1) * 100 if highs else None
    )
    full = last(volumes, 20)
    out["volume_z20"] = (
        (volumes[-1] - statistics.fmean(full)) / statistics.pstdev(full) if full else None
    )
    out["adt20"] = statistics.fmean(last(amounts, 20)) if last(amounts, 20) else None
    out["amount_change_pct"] = change(amounts, 1)
    out["history_sessions"], out["history_start_date"] = len(rows), rows[0][0]
    return out


@pytest.mark.parametrize("sessions", [30, 45])
def test_every_output_date_equals_a_build_for_that_date(spark, sessions):
    bars, factors = market(sessions)
    history, adjustments = frames(spark, bars, factors)
    panel = history_panel(history, adjustments, sessions=sessions)
    checked = 0
    for row in panel.collect():
        want = expected(bars, factors, row["thscode"], row["trade_date"], sessions)
        for field in FIELDS:
            if want[field] is None:
                assert row[field] is None, (row["thscode"], row["trade_date"], field)
            else:
                assert row[field] == pytest.approx(want[field], rel=1e-9, abs=1e-9), field
        assert row["history_sessions"] == want["history_sessions"]
        assert row["history_start_date"] == want["history_start_date"]
        checked += 1
    assert checked == len(bars)


@pytest.mark.parametrize("sessions", [30, None])
def test_factors_that_settle_within_days(spark, sessions):
    """Revisions up to RECENT days late, and first factors that come late or never."""
    bars, factors = market(11, delay=24 * RECENT)
    bars += [(d, "NEW", *rest) for d, code, *rest in bars if code == "GAPPY"]
    factors += [
        (d, "NEW", x, known + dt.timedelta(days=n % 5)) for n, (d, code, x, known) in
        enumerate(f for f in factors if f[1] == "GAPPY") if n > 3 and n % 9
    ]
    history, adjustments = frames(spark, bars, factors)
    panel = history_panel(history, adjustments, sessions=sessions)
    points = panel.collect()
    assert len(points) == len(bars)
    for row in points:
        want = expected(bars, factors, row["thscode"], row["trade_date"], sessions or 1000)
        for field in FIELDS:
            if want[field] is None:
                assert row[field] is None, (row["thscode"], row["trade_date"], field)
            else:
                assert row[field] == pytest.approx(want[field], rel=1e-9, abs=1e-9), field


def test_no_window_carries_gathered_rows(spark):
    """Lists of 252 rows that pass another window or sort are spilled row by row."""
    history, adjustments = frames(spark, *market(3, days=5))
    plan = history_panel(history, adjustments)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if line.strip(" :+-").startswith("Window")]
    gathers = ["collect_list" in line and "close" in line for line in lines]
    assert gathers.count(True) >= 1 and not any(
        "_recent#" in line.split("windowspecdefinition")[0] and "collect_list" not in line
        for line in lines
    )
    assert gathers.index(True) == 0, lines


def test_a_range_equals_the_same_dates_of_the_whole_panel(spark):
    bars, factors = market(7)
    history, adjustments = frames(spark, bars, factors)
    columns = ["trade_date", "thscode", *FIELDS]
    whole = history_panel(history, adjustments, sessions=30)
    part = history_panel(history, adjustments, day(50), day(60), sessions=30)
    inside = whole.where(F.col("trade_date").between(day(50), day(60)))
    key = lambda r: (r["trade_date"], r["thscode"])
    for a, b in zip(
        sorted(inside.select(columns).collect(), key=key),
        sorted(part.select(columns).collect(), key=key), strict=True,
    ):
        for x, y in zip(a, b):
            assert x == pytest.approx(y) if isinstance(x, float) else x == y


def test_factor_versions_stay_few_per_key(spark):
    stamp = dt.datetime.combine(day(0), dt.time(1))
    rows = [(day(0), "A", float(i + 1), stamp + dt.timedelta(minutes=i)) for i in range(500)]
    df = spark.createDataFrame(
        rows, "trade_date date, thscode string, adj_factor double, known_at timestamp"
    )
    (row,) = factor_versions(df).collect()
    assert [(v["decision_date"], v["adj_factor"]) for v in row["versions"]] == [(day(0), 500.0)]


def test_cash_split_and_rights_keep_adjusted_closes_level(spark):
    bars = []
    factors = []
    for code, closes, early in (
        ("CASH", (10.0, 9.8), 0.98), ("SPLIT", (100.0, 50.0), 0.5), ("RIGHTS", (20.0, 16.0), 0.8)
    ):
        for n, close in enumerate(closes):
            bars.append((day(n), code, close, 1.0, 1.0))
            known = dt.datetime.combine(day(1), dt.time(10, 30))
            factors.append((day(n), code, early if n == 0 else 1.0, known))
    history, adjustments = frames(spark, bars, factors)
    rows = apply_adjustments(history, adjustments, day(1)).collect()
    by_code = {}
    for r in rows:
        by_code.setdefault(r["thscode"], []).append(r["adjusted_close"])
    assert all(a == pytest.approx(b) for a, b in by_code.values())
    early = apply_adjustments(history, adjustments, day(0)).collect()
    assert all(r["adj_factor"] is None and not r["adjusted_ready"] for r in early)


def test_benchmark_uses_its_own_last_closes(spark):
    rows = [(day(n), "X", float(n + 1)) for n in range(30)]
    index = spark.createDataFrame(rows, "trade_date date, thscode string, close double")
    dates = spark.createDataFrame([(day(10),), (day(25),), (day(40),)], "trade_date date")
    found = {
        r["trade_date"]: r["X"] for r in benchmark_returns(index, dates, ["X", "Y"]).collect()
    }
    assert found[day(10)] is None
    assert found[day(25)] == pytest.approx((26 / 6 - 1) * 100)
    assert found[day(40)] == pytest.approx((30 / 10 - 1) * 100)
