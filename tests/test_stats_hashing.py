import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pitpanel.functions.hashing import content_hash, schema_signature
from pitpanel.functions.keys import (
    assert_unique, fit_columns, latest_per_key, outside, spread_join, unique_or_fail,
)
from pitpanel.functions.stats import decimal_sum, exact_median, reproducible_sums
from pitpanel.operators.adjust import derive_factors
from pitpanel.operators.explorer import explorer_rows
from pitpanel.operators.normalize import normalize_quotes
from pitpanel.operators.status import build_daily_security_status


@pytest.mark.parametrize("split_above", [5, 10_000])
def test_median_of_hot_and_small_groups(spark, split_above):
    rng = random.Random(4)
    rows = [("hot", rng.choice([rng.gauss(0, 1), 0.25, None])) for _ in range(4000)]
    rows += [("even", float(v)) for v in (1, 2, 3, 10)] + [("one", 7.0), ("none", None)]
    rows += [("same", 5.0)] * 300
    df = spark.createDataFrame(rows, "g string, v double")
    found = {
        r["g"]: r["m"]
        for r in exact_median(df, ["g"], "v", "m", buckets=16, split_above=split_above).collect()
    }
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert found == {g: pytest.approx(statistics.median(v)) for g, v in groups.items()}


def test_content_hash_sees_content_not_order(spark):
    rows = [(1, "a", 0.5), (1, "b", None), (2, "a", 1.5)]
    df = spark.createDataFrame(rows * 3, "k int, s string, v double")
    hashed = lambda d: {r["k"]: (r["rows"], r["sha256"]) for r in content_hash(d, ["k"]).collect()}
    base = hashed(df)
    assert hashed(df.repartition(7).orderBy(F.rand(1))) == base
    more = hashed(df.unionByName(df.where("s = 'b'").limit(1)))
    assert more[1] != base[1] and more[2] == base[2]
    changed = hashed(df.withColumn("v", F.when(F.col("s") == "b", 0.0).otherwise(F.col("v"))))
    assert changed[1] != base[1] and changed[2] == base[2]


def test_schema_signature_depends_on_names_and_types(spark):
    df = spark.range(1)
    assert schema_signature(df) == schema_signature(spark.range(5))
    assert schema_signature(df) != schema_signature(df.withColumn("id", F.col("id").cast("int")))


def test_latest_per_key_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "q")], "k int, o int, v string"
    )
    rows = latest_per_key(df, ["k"], ["o"]).collect()
    assert sorted((r["k"], r["v"]) for r in rows) == [(1, "b"), (2, "q")]


def test_spread_join_keeps_every_row_once(spark):
    big = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    small = spark.createDataFrame([("hot", 7)], "k string, x int")
    out = spread_join(big, small, ["k"], ["id"])
    assert out.count() == 1000 and out.where("x = 7").count() == 1000


def test_unique_and_outside(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    with pytest.raises(ValueError, match="repeated key: k=2"):
        assert_unique(df, ["k"], "test")
    assert [r[0] for r in outside(df, df.where("k = 2"), ["k"]).collect()] == [1]


def test_fit_columns_adds_typed_nulls(spark):
    out = fit_columns(spark.range(1), (("id", "int"), ("x", "array<string>")))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "array<string>"]


def test_reproducible_sums_do_not_depend_on_partitions(spark):
    draw = random.Random(12)
    rows = []
    for _ in range(3000):
        kind = draw.randrange(5)
        v = draw.uniform(-50, 50) if kind < 2 else draw.choice([1e300, -1e300, 1e16, -1e16, 3e-200, 0.0, -0.0]) if kind == 2 else draw.uniform(-1, 1) * 10.0 ** draw.randint(-20, 20)
        rows.append((draw.choice(["hot", "hot", "hot", "a", "b"]), v, None if draw.random() < 0.1 else draw.gauss(0, 1)))
    rows += [("none", None, None), ("one", 0.1, 2.5), ("odd", float("nan"), float("inf")), ("odd", 1.0, 1.0), ("odd", 2.0, float("inf"))]
    found = []
    for parts in (1, 7, 40):
        frame = spark.createDataFrame(rows, "k string, v double, w double").repartition(parts)
        found.append({r["k"]: tuple(map(repr, r[1:])) for r in reproducible_sums(frame, ["k"], ["v", "w"]).collect()})
    assert found[0] == found[1] == found[2]
    for k in ("hot", "a", "b", "one"):
        for i, name in ((1, 0), (2, 1)):
            values = [r[i] for r in rows if r[0] == k and r[i] is not None]
            total, count = float(found[0][k][name]), int(found[0][k][2 + name])
            assert count == len(values)
            assert abs(total - math.fsum(values)) <= 4e-16 * abs(math.fsum(values))
    assert "none" not in found[0] or found[0]["none"][:2] == ("None", "None")
    assert found[0]["odd"][:2] == ("nan", "inf")


def test_cancelling_values_leave_the_exact_rest(spark):
    rows = [("a", 1e16), ("a", 1.0), ("a", -1e16), ("a", 1e-9)] * 5
    frame = spark.createDataFrame(rows, "k string, v double")
    assert reproducible_sums(frame, ["k"], ["v"]).first()["v_sum"] == math.fsum(v for _, v in rows)


def test_a_repeated_key_fails_while_the_plan_runs(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 1)], "k string, n int")
    assert unique_or_fail(frame.where("n < 3"), ["k"], "rows").count() == 3
    with pytest.raises(Exception, match="rows has repeated key: k=b"):
        unique_or_fail(frame, ["k"], "rows").collect()
    with pytest.raises(Exception, match="repeated key"):  # the pair is not read, the check still runs
        unique_or_fail(frame, ["k"], "rows").select(F.lit(1).alias("one")).collect()


@pytest.mark.parametrize("case", ["universe", "quotes", "reference", "status", "raw", "adjusted", "metadata"])
def test_joins_refuse_a_planted_duplicate(spark, case):
    day = dt.date(2026, 8, 17)
    twice = lambda df, name: df.unionByName(df) if name == case else df
    listed = spark.createDataFrame([(day, "600000.SH", "n", "SSE", "SSE_MAIN")], "as_of_date date, thscode string, security_name string, exchange string, board string")
    measures = "close pre_close avg_price volume amount turnover_ratio change_ratio open high low".split()
    quotes = spark.createDataFrame([(day, "600000.SH", *[1.0] * len(measures), "p", "e")], "trade_date date, thscode string, " + ", ".join(f"{m} double" for m in measures) + ", source_provider string, source_endpoint string")
    shares = listed.select("as_of_date", "thscode", F.lit(day).alias("listing_date"), F.lit(1.0).alias("total_shares"), F.lit(1.0).alias("float_a_shares"))
    with pytest.raises(Exception, match="has repeated key: trade_date=2026-08-17, thscode=600000.SH"):
        if case in ("universe", "quotes"):
            build_daily_security_status(twice(listed, "universe"), twice(quotes, "quotes")).collect()
        elif case in ("raw", "adjusted"):
            derive_factors(twice(quotes, "raw"), twice(quotes, "adjusted"), F.lit(None).cast("timestamp"), "m", "p", "e").collect()
        elif case == "metadata":
            normalize_quotes(quotes, twice(listed, "metadata")).collect()
        else:
            status = build_daily_security_status(listed, quotes)
            explorer_rows(twice(status, "status"), twice(shares, "reference"), quotes).collect()


@pytest.mark.parametrize("split_above", [2, 4096])
def test_median_of_crowded_and_far_values(spark, split_above):
    rng, inf = random.Random(5), float("inf")
    groups = {
        "crowd": [1.0 + rng.random() * 1e-9 for _ in range(500)] + [1e300, -1e300, 1.999],
        "signs": [-3.5, -2e-310, -0.0, 0.0, 4e-320, 7.0, 1e-5, -1e-5],
        "far": [-inf, -inf, 5.0, 6.0, inf], "gap": [-1e308, -1e308, 1e308, 1e308],
        "edge": [-inf, 2.0], "wide": [rng.gauss(0, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(301)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {r["g"]: r["m"] for r in exact_median(df, ["g"], "v", "m", 4, split_above).collect()}
    assert found == {g: statistics.median(v) for g, v in groups.items()}
    dated = df.select(F.lit(dt.date(2026, 8, 17)).alias("trade_date"), "v").where("abs(v) < 2")
    (row,) = exact_median(dated, ["trade_date"], "v", "m", 4, split_above).collect()
    assert row["m"] == statistics.median([v for _, v in rows if abs(v) < 2])


def test_median_needs_no_sketch_and_ranks_few_rows(spark):
    df = spark.range(100).select(F.lit(dt.date(2026, 8, 17)).alias("trade_date"), F.col("id").cast("double").alias("v"))
    plan = exact_median(df, ["trade_date"], "v", "m")._jdf.queryExecution().toString()
    assert "percentile_approx" not in plan and "_cuts" not in plan


def test_decimal_sum_equals_the_sum_of_decimals(spark):
    rng = random.Random(6)
    rows = [("plain", rng.randint(-10**7, 10**7) / 100) for _ in range(500)]
    rows += [("odd", rng.choice([1.005, 2.675, 0.125, 1e12, -7.5e12 - 0.015, 0.1, 1e-9, -0.0])) for _ in range(200)]
    rows += [("large", 99999999999999.99), ("large", 87960930222.08), ("large", -0.01), ("none", None), ("some", None), ("some", 0.3)]
    df = spark.createDataFrame(rows, "k string, v double")
    for precision, scale in ((18, 2), (28, 4)):
        plain = F.sum(F.col("v").cast(f"decimal({precision},{scale})")).cast("double")
        got = df.groupBy("k").agg(decimal_sum("v", precision, scale).alias("a"), plain.alias("b")).collect()
        assert {r["k"]: r["a"] for r in got} == {r["k"]: r["b"] for r in got} and len(got) == 5
