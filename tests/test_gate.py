import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitpanel.operators import gate as G
from pitpanel.operators import normalize as N
from pitpanel.operators.status import build_daily_security_status
from pitpanel.operators.summary import build_market_summary, return_histogram

DAY = dt.date(2026, 8, 18)
CODES = ["600001.SH", "688001.SH", "000001.SZ", "920001.BJ"]
LIMITS = G.Thresholds(4, 0.98, 0.98, 0.95)
QUOTE = (
    "trade_date string, thscode string, open double, high double, low double, close double, "
    "pre_close double, avg_price double, volume double, amount double, "
    "turnover_ratio double, change_ratio double"
)


def universe_frame(spark, day=DAY):
    rows = [(day.isoformat(), c.lower(), f"N{i}", f"N{i}") for i, c in enumerate(CODES)]
    return spark.createDataFrame(
        rows, "as_of_date string, thscode string, security_name string, security_name_in_time string"
    )


def quote_frame(spark, day=DAY, codes=CODES):
    rows = [
        (day.isoformat(), c, 10.0, 11.0, 9.0, 10.5, 10.0, 10.2, 1000.0, 10200.0, 1.5, 5.0)
        for c in codes
    ]
    return with_source(spark.createDataFrame(rows, QUOTE))


def with_source(df):
    return df.withColumns({"source_provider": F.lit("t"), "source_endpoint": F.lit("t")})


def reference_frame(spark, day=DAY):
    rows = [(day.isoformat(), c, "20100101", 2000.0, 1000.0) for c in CODES]
    return with_source(spark.createDataFrame(
        rows, "as_of_date string, thscode string, listing_date string, total_shares double, "
        "float_a_shares double"
    ))


def calendar_frame(spark, day=DAY, is_open=True):
    rows = [(day.isoformat(), day.isoformat(), "SSE", "212001", is_open)]
    return with_source(spark.createDataFrame(
        rows, "as_of_date string, trade_date string, calendar string, market_code string, "
        "is_open boolean"
    ))


def inputs(spark, quotes=None, reference=None, calendar=None):
    universe = N.normalize_universe(universe_frame(spark))
    quotes = N.normalize_quotes(quotes if quotes is not None else quote_frame(spark), universe)
    reference = N.normalize_security_reference(
        reference if reference is not None else reference_frame(spark), universe
    )
    calendar = N.normalize_trade_calendar(calendar or calendar_frame(spark))
    status = build_daily_security_status(universe, quotes)
    return G.GateInputs(universe, reference, quotes, calendar, status)


def only(report):
    (row,) = report.where(F.col("run_date") == F.lit(DAY)).collect()
    return row


def test_clean_run_passes(spark):
    row = only(G.validate_data(inputs(spark), LIMITS))
    assert row["ok"] and row["errors"] == []
    assert row["universe_count"] == 4 and row["quote_coverage"] == 1.0
    assert row["calendar_open_dates"] == [DAY]


def test_bad_rows_give_explicit_messages(spark):
    quotes = quote_frame(spark).withColumns({
        "high": F.when(F.col("thscode") == "600001.SH", 5.0).otherwise(F.col("high")),
        "volume": F.when(F.col("thscode") == "000001.SZ", -1.0).otherwise(F.col("volume")),
        "pre_close": F.when(F.col("thscode") == "688001.SH", 0.0).otherwise(F.col("pre_close")),
        "change_ratio": F.when(F.col("thscode") == "920001.BJ", 9.0).otherwise(F.col("change_ratio")),
    })
    reference = reference_frame(spark).withColumns({
        "listing_date": F.lit("2030-01-01"), "float_a_shares": F.lit(3000.0),
    })
    row = only(G.validate_data(inputs(spark, quotes, reference), LIMITS))
    assert row["errors"] == [
        "quotes contain 1 invalid OHLC rows",
        "quotes contain 1 nonpositive price values",
        "quotes contain 1 negative volume rows",
        "quotes contain 1 average prices outside daily range",
        "quotes contain 1 inconsistent change-ratio rows",
        "security reference contains 4 future listing dates",
        "security reference contains 4 float shares above total shares",
    ]


def test_wrong_source_date_is_named(spark):
    base = inputs(spark)
    moved = base.quotes.withColumns({
        "run_date": F.col("trade_date"), "trade_date": F.date_add("trade_date", -1),
    })
    row = only(G.validate_data(
        G.GateInputs(base.universe, base.reference, moved, base.calendar, base.status), LIMITS
    ))
    assert row["errors"] == [
        "quote source dates ['2026-08-17'] do not match 2026-08-18"
    ]


def test_missing_tables_and_codes(spark):
    base = inputs(spark, quote_frame(spark, codes=CODES[:2]))
    row = only(G.validate_data(
        G.GateInputs(base.universe, base.reference.limit(0), base.quotes, base.calendar,
                     base.status.where("thscode <> '600001.SH'")), LIMITS
    ))
    assert row["errors"] == [
        "quote_coverage 0.5000 below minimum 0.9800",
        "reference_coverage 0.0000 below minimum 0.9800",
        "listing_date_coverage 0.0000 below minimum 0.9500",
        "total_shares_coverage 0.0000 below minimum 0.9500",
        "float_a_shares_coverage 0.0000 below minimum 0.9500",
        "security reference source dates [] do not match 2026-08-18",
        "quotes do not cover SSE, SZSE, and BSE",
        "daily status universe mismatch: missing=1, extra=0",
        "daily status quote_row_present does not match quote codes",
    ]


def test_duplicates_strays_and_unknown_states(spark):
    base = inputs(spark)
    stray = base.quotes.limit(1).withColumn("thscode", F.lit("600009.SH"))
    row = only(G.validate_data(
        G.GateInputs(
            base.universe, base.reference.unionByName(base.reference.limit(1)),
            base.quotes.unionByName(stray), base.calendar,
            base.status.withColumn("observation_state", F.lit("halted")),
        ), LIMITS,
    ))
    assert row["errors"] == [
        "security reference contains 1 duplicate codes",
        "quotes contain 1 codes outside universe",
        "daily status quote_row_present does not match quote codes",
        "daily status contains unsupported observation states",
    ]


def test_rounding_below_a_micro_passes(spark):
    quotes = quote_frame(spark).withColumn("avg_price", F.col("low") - 1.3e-8)
    assert only(G.validate_data(inputs(spark, quotes), LIMITS))["ok"]


def test_missing_quote_is_not_a_suspension(spark):
    universe = N.normalize_universe(universe_frame(spark))
    quotes = N.normalize_quotes(quote_frame(spark, codes=CODES[:3]), universe)
    quotes = quotes.withColumn(
        "amount", F.when(F.col("thscode") == CODES[1], 0.0).otherwise(F.col("amount"))
    )
    status = build_daily_security_status(universe, quotes)
    found = {r["thscode"]: r["observation_state"] for r in status.collect()}
    assert found == {
        CODES[0]: "traded", CODES[1]: "quote_without_turnover", CODES[2]: "traded",
        CODES[3]: "no_quote_observed",
    }
    assert not [c for c in status.columns if "suspend" in c]


def test_required_columns_are_listed(spark):
    with pytest.raises(ValueError, match="universe missing columns: as_of_date, thscode"):
        N.normalize_universe(universe_frame(spark).drop("as_of_date", "thscode"))


def test_summary_and_histogram(spark):
    changes = [-10.0, 0.0, 10.0, 10.1]
    quotes = inputs(spark).quotes.withColumn(
        "change_ratio",
        F.element_at(F.array(*[F.lit(c) for c in changes]),
                     F.array_position(F.array(*[F.lit(c) for c in CODES]), F.col("thscode"))
                     .cast("int")),
    )
    (row,) = build_market_summary(quotes).collect()
    assert (row["advancers"], row["decliners"], row["unchanged"]) == (2, 1, 1)
    assert (row["moves_ge_9_5pct"], row["moves_le_minus_9_5pct"]) == (2, 1)
    assert row["median_change_pct"] == 5.0
    assert row["exchange_quote_counts"] == {"SSE": 2, "SZSE": 1, "BSE": 1}
    bins = {r["label"]: r["row_count"] for r in return_histogram(quotes).collect()}
    assert len(bins) == 12 and bins["≤-10"] == 1 and bins["-1~0"] == 1
    assert bins["7~10"] == 1 and bins[">10"] == 1
