"""Rows dealt by code once: later steps shuffle nothing wide, and results stay whole."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from pitpanel.functions.keys import deal, stack_join
from pitpanel.operators import temporal as TP
from pitpanel.plans import roles
from pitpanel.plans.driver_queries import READ_STATE, counted_state
from pitpanel.plans.roles import Roles

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no driver tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_by(df):
    """The keys of every shuffle in the plan, without their numbers."""
    found = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))
    return [re.sub(r"#\d+L?", "", keys) for keys in found]


def by_date_and_code(df):
    return [k for k in shuffled_by(df) if "date" in k and "thscode" in k]


def keyed(spark, rows, value):
    return spark.createDataFrame(rows, f"trade_date string, thscode string, {value} long")


def test_stacked_tables_equal_a_left_join_and_are_shuffled_once(spark):
    base = keyed(spark, [("d1", "a", 1), ("d1", "b", None), ("d2", "a", 3), (None, "a", 4)], "x")
    other = keyed(spark, [("d1", "a", 10), ("d2", "b", 20), ("d2", "a", None), (None, "a", 40)], "y")
    keys = ["thscode", "trade_date"]
    joined = stack_join(deal(base, 3), {"other": deal(other, 3)}, keys, "base")
    assert shuffled_by(joined) == ["thscode, 3", "thscode, 3"]
    want = base.join(other, keys, "left").select(*joined.columns)
    assert joined.columns == ["trade_date", "thscode", "x", "y"]
    assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("repeated", ["base", "other"])
def test_stacked_tables_fail_on_a_repeated_key(spark, repeated):
    base, other = keyed(spark, [("d1", "a", 1)], "x"), keyed(spark, [("d1", "b", 2)], "y")
    twice = lambda df, name: df.union(df) if name == repeated else df
    joined = stack_join(
        twice(base, "base"), {"other": twice(other, "other")}, ["trade_date", "thscode"], "base"
    )
    with pytest.raises(Exception, match=f"{repeated} has repeated key: trade_date=d1, thscode="):
        joined.collect()


def test_several_timelines_share_one_sort_and_leave_the_rows_where_they_are(spark):
    rows = spark.sql("SELECT DATE '2026-01-01' + CAST(id AS INT) AS trade_date, CAST(id % 1 AS STRING) AS thscode FROM range(6)")
    line = lambda name, first, last: spark.sql(
        f"SELECT CAST(id AS STRING) AS thscode, DATE '{first}' AS segment_from, DATE '{last}' AS segment_to, '{name}' AS {name} FROM range(1)"
    )
    lines = [line("x", "2026-01-02", "2026-01-03"), line("y", "2026-01-03", "2026-12-31")]
    joined = TP.join_segments(deal(rows, 3), lines, ["thscode"], parts=3)
    assert set(shuffled_by(joined)) == {"thscode, 3"} and plan_of(joined).count("Sort [") == 1
    held = [(r.trade_date.day, r.x, r.y) for r in joined.orderBy("trade_date").collect()]
    assert held == [(1, None, None), (2, "x", None), (3, "x", "y"), (4, None, "y"), (5, None, "y"), (6, None, "y")]


@needs_data
def test_heavy_suppliers_give_the_same_bars(spark, monkeypatch):
    want = Roles(spark, SMALL).daily_quotes
    monkeypatch.setattr(roles, "MANY_LINES", 600)
    heavy = Roles(spark, SMALL)
    assert heavy.heavy
    assert heavy.daily_quotes.count() == want.count() > 0
    assert heavy.daily_quotes.exceptAll(want).isEmpty()


@needs_data
def test_state_never_shuffles_or_writes_its_wide_rows(spark):
    state = entry_point.entry(spark)
    assert "/panel-" not in plan_of(state)
    wide = [k for k in shuffled_by(state) if "_part" in k or "trade_date, thscode" in k]
    assert not wide, wide


@needs_data
def test_a_document_writes_presence_where_it_only_counts(spark):
    state = entry_point.queries()["stock_state"](spark, SMALL)
    counted = counted_state(state)
    kinds = dict(counted.dtypes)
    assert kinds["total_return_index"] == kinds["index_memberships"] == "boolean"
    assert counted.columns == state.columns
    assert {c: kinds[c] for c in READ_STATE} == {c: dict(state.dtypes)[c] for c in READ_STATE}


@needs_data
@pytest.mark.parametrize("name", ["quality_metrics", "quality_errors", "explorer_rows", "tradability_state", "tradability_reasons", "normalize_quotes"])
def test_tables_dealt_by_code_are_not_shuffled_by_date_and_code(spark, name):
    assert not by_date_and_code(entry_point.queries()[name](spark, SMALL))
