"""Normalizing projections: types, codes, derived columns, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.keys import deal, latest_per_key, require_columns, stack_join
from pitpanel.functions.scalars import (
    board_of, code_text, date_of, double_of, exchange_of, first_decision_date,
    instant_us,
)
from pitpanel.schemas import (
    CALENDAR_COLUMNS, QUOTE_COLUMNS, QUOTE_MEASURES, REFERENCE_COLUMNS,
    UNIVERSE_COLUMNS,
)


def _codes(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Codes in their own form; with ``parts`` the rows are dealt by it."""
    return deal(df.withColumn("thscode", code_text(F.col("thscode"))), parts)


def _dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: date_of(df, name) for name in names})


def _doubles(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: double_of(name) for name in names})


def _trimmed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.trim(F.col(name)) for name in names})


def with_knowledge_date(df: DataFrame) -> DataFrame:
    """Add ``known_us`` and ``decision_date``, the first date that may use the row."""
    return df.withColumn("known_us", instant_us(df, "known_at")).withColumn(
        "decision_date", first_decision_date(F.col("known_us"))
    )


def normalize_universe(
    df: DataFrame, order: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Listed codes with exchange and board, one row per date and code."""
    out = _dates(_codes(require_columns(df, "universe"), parts), "as_of_date")
    out = out.withColumns({
        "exchange": exchange_of(F.col("thscode")),
        "board": board_of(F.col("thscode")),
    }).where(F.col("exchange") != "UNKNOWN")
    out = out.select(*UNIVERSE_COLUMNS, *[c for c in order if c not in UNIVERSE_COLUMNS])
    return latest_per_key(out, ["as_of_date", "thscode"], order).select(
        *UNIVERSE_COLUMNS
    )


def _with_universe(df: DataFrame, universe: DataFrame, date: str) -> DataFrame:
    metadata = universe.select(
        F.col("as_of_date").alias(date), "thscode", "security_name", "exchange",
        "board",
    )
    own = [c for c in ("security_name", "exchange", "board") if c in df.columns]
    return stack_join(df.drop(*own), {"universe": metadata}, [date, "thscode"], "rows")


def normalize_security_reference(
    df: DataFrame, universe: DataFrame, order: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    out = _dates(
        _codes(require_columns(df, "security reference"), parts), "as_of_date", "listing_date"
    )
    out = _doubles(out, ("total_shares", "float_a_shares"))
    out = latest_per_key(out, ["as_of_date", "thscode"], order)
    return _with_universe(out, universe, "as_of_date").select(*REFERENCE_COLUMNS)


def normalize_quotes(
    df: DataFrame, universe: DataFrame, order: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    out = _dates(_codes(require_columns(df, "quotes"), parts), "trade_date")
    out = _doubles(out, QUOTE_MEASURES)
    out = latest_per_key(out, ["trade_date", "thscode"], order)
    return _with_universe(out, universe, "trade_date").select(*QUOTE_COLUMNS)


def normalize_trade_calendar(
    df: DataFrame, order: Sequence[str] = (), by_run: bool = False
) -> DataFrame:
    """One row per calendar and date; with ``by_run`` also per as-of date."""
    out = _dates(require_columns(df, "trade calendar"), "as_of_date", "trade_date")
    out = out.withColumns({
        "market_code": F.col("market_code").cast("string"),
        "is_open": F.col("is_open").cast("boolean"),
    }).where(F.col("trade_date").isNotNull())
    order = order or ("as_of_date",)
    out = out.select(*CALENDAR_COLUMNS, *[c for c in order if c not in CALENDAR_COLUMNS])
    keys = ["as_of_date"] if by_run else []
    order = [c for c in order if c not in keys]
    return latest_per_key(out, [*keys, "calendar", "trade_date"], order).select(
        *CALENDAR_COLUMNS
    )


def normalize_adjustments(df: DataFrame, parts: int | None = None) -> DataFrame:
    out = _dates(_codes(require_columns(df, "adjustments"), parts), "trade_date")
    out = _doubles(out, ("adj_factor",)).where(F.col("adj_factor") > 0)
    return with_knowledge_date(out)


def normalize_corporate_actions(df: DataFrame, parts: int | None = None) -> DataFrame:
    out = _dates(_codes(require_columns(df, "corporate actions"), parts), "effective_at")
    return with_knowledge_date(_trimmed(out, "event_type"))


def normalize_industry_membership(df: DataFrame) -> DataFrame:
    out = _dates(
        _codes(require_columns(df, "industry membership")),
        "effective_from", "effective_to",
    )
    out = _trimmed(
        out, "classification_system", "level", "industry_code", "industry_name"
    )
    return with_knowledge_date(out.withColumn("level", F.upper("level")))


def normalize_index_membership(df: DataFrame) -> DataFrame:
    out = _dates(
        _codes(require_columns(df, "index membership")),
        "effective_from", "effective_to",
    )
    out = _doubles(_trimmed(out, "index_name"), ("weight",))
    return with_knowledge_date(
        out.withColumn("index_code", code_text(F.col("index_code")))
    )


# Provider flags; the last three are optional in the input.
PROVIDER_FLAGS = (
    "is_st", "is_suspended", "stock_connect_eligible", "margin_eligible",
    "short_sell_eligible",
)


def normalize_provider_tradability(df: DataFrame, parts: int | None = None) -> DataFrame:
    out = _dates(_codes(require_columns(df, "provider tradability"), parts), "as_of_date")
    have = set(out.columns)
    out = out.withColumns({
        name: (F.col(name) if name in have else F.lit(None)).cast("boolean")
        for name in PROVIDER_FLAGS
    })
    return with_knowledge_date(_doubles(out, ("daily_price_limit_pct", "lot_size")))
