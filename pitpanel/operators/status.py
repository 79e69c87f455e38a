"""Observation status: what was seen for each universe code on each date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.keys import stack_join
from pitpanel.functions.scalars import truthy
from pitpanel.schemas import STATUS_COLUMNS


def build_daily_security_status(
    universe: DataFrame,
    quotes: DataFrame,
    provider: str = "derived",
    endpoint: str = "universe+cmd_history_quotation",
) -> DataFrame:
    """A missing quote stays ``no_quote_observed``; it is never a suspension.

    Quotes and universe hold a (date, code) once, or the plan fails.
    """
    keys = ["trade_date", "thscode"]
    observed = quotes.select(
        "trade_date", "thscode", "close", "volume", "amount",
        F.lit(True).alias("_seen"),
    )
    listed = universe.select(
        F.col("as_of_date").alias("trade_date"), "thscode", "security_name",
        "exchange", "board",
    )
    traded = truthy((F.col("volume") > 0) & (F.col("amount") > 0))
    seen = truthy(F.col("_seen"))
    return stack_join(listed, {"quotes": observed}, keys, "universe").withColumns({
        "quote_row_present": seen,
        "has_price_observation": F.col("close").isNotNull(),
        "has_turnover_observation": traded,
        "observation_state": F.when(traded, "traded")
        .when(seen, "quote_without_turnover")
        .otherwise("no_quote_observed"),
        "source_provider": F.lit(provider),
        "source_endpoint": F.lit(endpoint),
    }).select(*STATUS_COLUMNS)
