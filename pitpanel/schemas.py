"""Column lists, types and limits shared by all operators."""

from __future__ import annotations


# Dataset columns, in output order.
UNIVERSE_COLUMNS = (
    "as_of_date", "thscode", "security_name", "security_name_in_time",
    "exchange", "board",
)
REFERENCE_COLUMNS = (
    "as_of_date", "thscode", "security_name", "exchange", "board", "listing_date",
    "total_shares", "float_a_shares", "source_provider", "source_endpoint",
)
QUOTE_COLUMNS = (
    "trade_date", "thscode", "security_name", "exchange", "board",
    "open", "high", "low", "close", "pre_close", "avg_price", "volume", "amount",
    "turnover_ratio", "change_ratio", "source_provider", "source_endpoint",
)
CALENDAR_COLUMNS = (
    "as_of_date", "trade_date", "calendar", "market_code", "is_open",
    "source_provider", "source_endpoint",
)
STATUS_COLUMNS = (
    "trade_date", "thscode", "security_name", "exchange", "board",
    "quote_row_present", "has_price_observation", "has_turnover_observation",
    "observation_state", "source_provider", "source_endpoint",
)

# The measures of a daily quote.
QUOTE_MEASURES = (
    "open", "high", "low", "close", "pre_close", "avg_price", "volume", "amount",
    "turnover_ratio", "change_ratio",
)

# Input columns each dataset must carry.
REQUIRED_COLUMNS = {
    "universe": {"as_of_date", "thscode", "security_name", "security_name_in_time"},
    "security reference": {
        "as_of_date", "thscode", "listing_date", "total_shares", "float_a_shares",
        "source_provider", "source_endpoint",
    },
    "quotes": {
        "trade_date", "thscode", *QUOTE_MEASURES, "source_provider", "source_endpoint",
    },
    "trade calendar": set(CALENDAR_COLUMNS),
    "adjustments": {"trade_date", "thscode", "adj_factor", "known_at"},
    "corporate actions": {
        "thscode", "event_type", "published_at", "effective_at", "known_at",
    },
    "industry membership": {
        "thscode", "classification_system", "level", "industry_code",
        "industry_name", "effective_from", "effective_to", "known_at",
    },
    "index membership": {
        "index_code", "index_name", "thscode", "weight", "effective_from",
        "effective_to", "known_at",
    },
    "provider tradability": {
        "as_of_date", "thscode", "is_st", "is_suspended", "daily_price_limit_pct",
        "lot_size", "known_at",
    },
}

# The per-security state, in output order.
STOCK_STATE_FIELDS = (
    ("schema_version", "int"),
    ("trade_date", "date"),
    ("data_cutoff_time", "string"),
    ("thscode", "string"),
    ("security_name", "string"),
    ("exchange", "string"),
    ("board", "string"),
    ("raw_close", "double"),
    ("adj_factor", "double"),
    ("forward_adj_close", "double"),
    ("adjusted_close", "double"),
    ("total_return_index", "double"),
    ("corporate_action_flag", "boolean"),
    ("corporate_action_types", "array<string>"),
    ("adjusted_ready", "boolean"),
    ("return_1d_pct", "double"),
    ("return_3d_pct", "double"),
    ("return_5d_pct", "double"),
    ("return_20d_pct", "double"),
    ("return_60d_pct", "double"),
    ("rv20_pct", "double"),
    ("rv60_pct", "double"),
    ("turnover_z20", "double"),
    ("amount_z20", "double"),
    ("volume_z20", "double"),
    ("gap_pct", "double"),
    ("intraday_range_pct", "double"),
    ("close_location", "double"),
    ("close_vs_avg_pct", "double"),
    ("turnover_change_pct", "double"),
    ("amount_change_pct", "double"),
    ("float_market_cap", "double"),
    ("total_market_cap", "double"),
    ("distance_from_high_20_pct", "double"),
    ("distance_from_high_60_pct", "double"),
    ("drawdown_from_high_252_pct", "double"),
    ("relative_return_industry_20d_pct", "double"),
    ("relative_return_csi300_20d_pct", "double"),
    ("relative_return_csi1000_20d_pct", "double"),
    ("sw1_code", "string"),
    ("sw1_name", "string"),
    ("sw2_code", "string"),
    ("sw2_name", "string"),
    ("index_memberships", "array<string>"),
    ("history_sessions", "int"),
    ("history_start_date", "date"),
    ("listing_age_calendar_days", "int"),
    ("adt20", "double"),
    ("is_st", "boolean"),
    ("is_suspended", "boolean"),
    ("limit_up", "boolean"),
    ("limit_down", "boolean"),
    ("one_word_limit", "boolean"),
    ("daily_price_limit_pct", "double"),
    ("lot_size", "double"),
    ("stock_connect_eligible", "boolean"),
    ("margin_eligible", "boolean"),
    ("short_sell_eligible", "boolean"),
    ("tradability_state", "string"),
    ("tradability_reason_codes", "array<string>"),
    ("source_snapshot_sha256", "string"),
)
STOCK_STATE_COLUMNS = tuple(name for name, _ in STOCK_STATE_FIELDS)

# Versions, limits and thresholds.
SCHEMA_VERSION = 2
TARGET_HISTORY_SESSIONS = 252
SNAPSHOT_LIMIT = 60
MAX_DOCUMENT_BYTES = 2 * 1024 * 1024
MIN_ADJUSTMENT_COVERAGE = 0.98
MIN_INDUSTRY_COVERAGE = 0.95
MIN_TRADABILITY_COVERAGE = 0.95
MIN_ADT20 = 20_000_000.0
MIN_LISTING_AGE_DAYS = 30
PRICE_TOLERANCE = 1e-6

# State vocabularies.
READINESS_STATES = ("ready", "stale", "missing", "not_entitled")
OBSERVATION_STATES = ("traded", "quote_without_turnover", "no_quote_observed")
REQUIRED_EXCHANGES = ("SSE", "SZSE", "BSE")

# The two benchmark indexes and the state columns they feed.
BENCHMARKS = {"000300.SH": "CSI300", "000852.SH": "CSI1000"}
