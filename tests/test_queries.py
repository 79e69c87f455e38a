from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from pitpanel.functions.keys import latest_per_key, spread_join
from pitpanel.plans import roles
from pitpanel.plans.roles import Roles
from tools.check_queries import TABLES, table

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no driver tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_sql_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@needs_data
@pytest.mark.parametrize("name", [
    "exchange_board_codes", "known_by_factors", "active_industry", "active_index_members",
    "tradability_reasons", "content_hash", "non_trading_weekdays", "total_return_index",
])
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()[name])
    want = table([d[0] for d in result.description], result.fetchall())
    df = entry_point.queries()[name](spark, SMALL)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@needs_data
def test_explorer_rows_keeps_every_column(spark):
    df = entry_point.queries()["explorer_rows"](spark, SMALL)
    assert len(df.columns) == 16 and {"close", "avg_price", "listing_date"} <= set(df.columns)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()["explorer_rows"])
    want = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.fixture
def thousands(tmp_path):
    """The small tables, their suppliers numbered from 1,000 on."""
    for t in TABLES:
        key = {"supplier": "s_suppkey", "lineitem": "l_suppkey"}.get(t)
        shift = f"REPLACE ({key} + 1000 AS {key})" if key else ""
        duckdb.sql(f"COPY (SELECT * {shift} FROM '{SMALL}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    return str(tmp_path)


@needs_data
def test_universe_feed_keeps_codes_of_seven_digits(spark, thousands):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{thousands}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()["universe_feed"])
    want = table([d[0] for d in result.description], result.fetchall())
    df = entry_point.queries()["universe_feed"](spark, thousands)
    assert want and table(df.columns, [tuple(r) for r in df.collect()]) == want


@needs_data
def test_universe_makes_no_row_twice(spark):
    """No row is made again only to be dropped by a shuffle of the whole universe."""
    listed = Roles(spark, SMALL).universe
    assert listed.count() == listed.distinct().count() > 0
    plan = plan_of(listed)
    assert "Generate explode" in plan and "keys=[as_of_date" not in plan
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()["normalize_universe"])
    want = table([d[0] for d in result.description], result.fetchall())
    df = entry_point.queries()["normalize_universe"](spark, SMALL)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@needs_data
def test_reference_feed_lands_its_rows_from_one_plan(spark):
    plan = plan_of(entry_point.queries()["reference_feed"](spark, SMALL))
    assert "Union" not in plan


@needs_data
@pytest.mark.parametrize("name", ["market_summary", "breadth_shares"])
def test_summaries_make_their_quotes_once(spark, name):
    df = entry_point.queries()[name](spark, SMALL)
    assert "lineitem" not in plan_of(df)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()[name])
    want = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@needs_data
@pytest.mark.parametrize("many", [0, 600, 1_000_000])
def test_quote_moves_are_those_of_the_quotes(spark, monkeypatch, many):
    """Whichever way the lines of a supplier take; rows are shuffled by supplier only."""
    monkeypatch.setattr(roles, "MANY_LINES", many)
    moves = Roles(spark, SMALL).quote_moves
    want = Roles(spark, SMALL).daily_quotes.select(*moves.columns)
    assert moves.count() == want.count() > 0 and moves.exceptAll(want).isEmpty()
    assert "hashpartitioning(thscode" not in plan_of(moves)


@needs_data
def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry_point.queries()["last_n_sessions_scan"](spark, SMALL))
    assert "l_comment" not in plan and "l_tax" not in plan


def test_salted_join_is_partitioned_by_the_salt(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
        small = big.groupBy("k").agg(F.sum("id").alias("s"))
        plan = plan_of(spread_join(big, small, ["k"], ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_part" in line for line in joined) == 2, plan


def test_latest_per_key_trims_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"], ["id"]))
    before = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_no_python_udfs_in_the_state_plan(spark):
    if not Path(SMALL).exists():
        pytest.skip("no driver tables")
    plan = plan_of(entry_point.entry(spark))
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
