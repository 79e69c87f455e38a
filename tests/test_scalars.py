import datetime as dt

from pyspark.sql import functions as F

from pitpanel.functions import scalars as S


def test_exchange_and_board(spark):
    cases = {
        "600001.SH": ("SSE", "SSE_MAIN"), "688001.SH": ("SSE", "STAR"),
        "000001.SZ": ("SZSE", "SZSE_MAIN"), "300001.SZ": ("SZSE", "CHINEXT"),
        "301001.SZ": ("SZSE", "CHINEXT"), "920001.BJ": ("BSE", "BSE"),
        "12.HK": ("UNKNOWN", "UNKNOWN"),
    }
    df = spark.createDataFrame([(c,) for c in cases], "code string")
    rows = df.select(
        "code", S.exchange_of(F.col("code")), S.board_of(F.col("code"))
    ).collect()
    assert {r[0]: (r[1], r[2]) for r in rows} == cases


def test_listed_code_pattern(spark):
    df = spark.createDataFrame([("600001.SH",), ("bad",), ("600001.sh",), (None,)], "c string")
    assert [r[0] for r in df.select(S.is_listed_code(F.col("c"))).collect()] == [
        True, False, True, False
    ]


def test_dates_parse_or_become_null(spark):
    df = spark.createDataFrame(
        [("20260818",), ("2026-08-18",), ("2026-08-18 09:00:00",), ("soon",), ("20261399",)],
        "d string",
    )
    day = dt.date(2026, 8, 18)
    assert [r[0] for r in df.select(S.date_of(df, "d")).collect()] == [
        day, day, day, None, None
    ]


def test_doubles_coerce(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), ("Infinity",), (None,)], "v string")
    assert [r[0] for r in df.select(S.double_of("v")).collect()] == [1.5, None, None, None, None]


def test_knowledge_at_the_cutoff_boundary(spark):
    cases = [
        ("2026-08-20T20:15:00+08:00", dt.date(2026, 8, 20)),
        ("2026-08-20T20:15:00.000001+08:00", dt.date(2026, 8, 21)),
        ("2026-08-20T23:00:00+08:00", dt.date(2026, 8, 21)),
        ("2026-08-20T12:15:00", dt.date(2026, 8, 20)),
        ("2026-08-20T12:15:00Z", dt.date(2026, 8, 20)),
        ("1969-12-31T23:00:00Z", dt.date(1970, 1, 1)),
        ("never", None),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "known_at string")
    rows = df.select(S.first_decision_date(S.instant_us(df, "known_at"))).collect()
    assert [r[0] for r in rows] == [d for _, d in cases]


def test_naive_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2026-08-20 12:15:00",)], "k string")
    df = df.select(F.col("k").cast("timestamp_ntz").alias("k"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = df.select(S.first_decision_date(S.instant_us(df, "k"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == dt.date(2026, 8, 20)
