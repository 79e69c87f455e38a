"""Manifest rows, change detection, run states, retention and the data catalog."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.hashing import content_hash, schema_signature
from pitpanel.functions.keys import latest_per_key
from pitpanel.functions.scalars import truthy
from pitpanel.schemas import SNAPSHOT_LIMIT, TARGET_HISTORY_SESSIONS

# Catalog descriptions by dataset.
DESCRIPTIONS = {
    "universe": "PIT A-share security universe",
    "security_reference": "security names, boards, listing and share data",
    "daily_quotes": "unadjusted daily OHLCV and turnover facts",
    "trading_calendar": "SSE trading-calendar observations",
    "daily_security_status": "quote observation status by security",
    "market_summary": "factual market breadth and turnover aggregates",
}
OTHER_DESCRIPTION = "verified snapshot artifact"
STATE_DESCRIPTION = "PIT per-security adjusted-price and market-state fields"
DERIVED = ("stock_state", "reference_document")


def artifact_rows(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(trade_date, name, rows, sha256, schema_sha256) for every table and date.

    ``tables`` maps a dataset name to its frame and date column.
    """
    out = None
    for name, (df, date) in tables.items():
        part = content_hash(df, [date]).select(
            F.col(date).alias("trade_date"), F.lit(name).alias("name"), "rows", "sha256",
            F.lit(schema_signature(df)).alias("schema_sha256"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def changed_dates(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Per date: whether every dataset's content hash equals the stored one."""
    before = latest_per_key(
        stored.select("trade_date", "name", "sha256", "published_at"),
        ["trade_date", "name"], ["published_at"],
    ).select("trade_date", "name", F.col("sha256").alias("_stored"))
    same = truthy(F.col("sha256") == F.col("_stored"))
    return (
        fresh.join(before, ["trade_date", "name"], "left")
        .groupBy("trade_date")
        .agg(
            F.bool_and(same).alias("unchanged"),
            F.bool_or(F.col("_stored").isNotNull()).alias("known_before"),
        )
    )


def run_states(df: DataFrame) -> DataFrame:
    """Outcome per requested date.

    Needs ``collected``, ``is_open``, ``gate_ok``, ``unchanged``,
    ``derived_failed`` and ``previous_latest``.
    """
    date, latest = F.col("trade_date"), F.col("previous_latest")
    promoted = latest.isNull() | (date >= latest)
    state = (
        F.when(~truthy(F.col("collected")), "failed_collection")
        .when(~truthy(F.col("is_open")), "market_closed")
        .when(~truthy(F.col("gate_ok")), "failed_quality")
        .when(truthy(F.col("unchanged")) & truthy(F.col("derived_failed")), "success_partial")
        .when(truthy(F.col("unchanged")) & truthy(date == latest), "success_unchanged")
        .when(truthy(F.col("unchanged")), "success_historical_unchanged")
        .when(~promoted, "success_historical")
        .when(truthy(F.col("derived_failed")), "success_partial")
        .otherwise("success")
    )
    fresh = state.startswith("success")
    return df.withColumns({
        "state": state,
        "data_fresh": fresh,
        "last_valid_trade_date": F.when(
            fresh & promoted, F.greatest(date, latest)
        ).otherwise(latest),
    })


def backfill_state(states: DataFrame) -> DataFrame:
    """One row: outcome of a range, its first failing date and completed dates.

    ``states`` has one row per requested date, which bounds the list.
    """
    failed = F.col("state").startswith("failed")
    entry = F.struct("trade_date", "data_fresh")
    collected = states.agg(
        F.min(F.when(failed, F.col("trade_date"))).alias("failed_date"),
        F.array_sort(F.collect_list(entry)).alias("_days"),
    )
    before = F.filter(
        "_days",
        lambda d: d["data_fresh"]
        & F.coalesce(d["trade_date"] < F.col("failed_date"), F.lit(True)),
    )
    listed = collected.select("failed_date", before["trade_date"].alias("done"))
    return listed.select(
        F.when(F.col("failed_date").isNotNull(), "failed_backfill")
        .when(F.size("done") > 0, "success_backfill")
        .otherwise("market_closed").alias("state"),
        "failed_date", F.col("done").alias("completed_trade_dates"),
        F.size("done").alias("completed_count"),
    )


def _newest_first(date: str) -> Column:
    return F.row_number().over(Window.orderBy(F.desc(date)))


def retention_plan(
    dates: DataFrame, keep: int = SNAPSHOT_LIMIT, date: str = "trade_date"
) -> DataFrame:
    """Snapshot dates to drop: all but the newest ``keep``. Facts never are."""
    listed = dates.select(date).where(F.col(date).isNotNull()).distinct()
    return listed.withColumn("_rank", _newest_first(date)).where(
        F.col("_rank") > keep
    ).select(date)


def upsert_market_history(
    stored: DataFrame, fresh: DataFrame, keep: int = TARGET_HISTORY_SESSIONS
) -> DataFrame:
    """Replace summaries by date and keep the newest ``keep``; one row per date."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(
        fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    current = Window.partitionBy("trade_date").orderBy(F.desc("_new"))
    single = both.withColumn("_row", F.row_number().over(current)).where("_row = 1")
    return single.withColumn("_rank", _newest_first("trade_date")).where(
        F.col("_rank") <= keep
    ).drop("_new", "_row", "_rank")


def missing_partitions(
    required: DataFrame, *datasets: DataFrame, columns: Sequence[Collection[str]] = ()
) -> DataFrame:
    """Required dates that do not have rows in every one of the datasets.

    ``columns`` names what each dataset must have for its rows to be reusable, in the
    same order; a dataset that lacks one of its columns has no reusable date.
    """
    ready = None
    for df, needed in zip_longest(datasets, columns, fillvalue=()):
        dates = df.select("as_of_date").distinct()
        if not set(needed) <= set(df.columns):
            dates = dates.limit(0)
        ready = dates if ready is None else ready.join(dates, "as_of_date", "left_semi")
    dates = required.select("trade_date").distinct()
    return dates.join(ready, dates["trade_date"] == ready["as_of_date"], "left_anti")


def upsert_module_status(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    return latest_per_key(
        stored.unionByName(fresh, allowMissingColumns=True),
        ["as_of_date", "module"], ["checked_at_utc"],
    )


def provenance_text(artifacts: DataFrame, given: Mapping[str, str] | None = None) -> DataFrame:
    """(trade_date, provenance): what a date was made of, as JSON with sorted keys.

    ``given`` says where the data came from; the content hash and the schema signature
    of every artifact join it.
    """
    entry = lambda name, value: F.struct(name.alias("key"), value.alias("value"))
    found = F.array(
        entry(F.concat("name", F.lit("_frame_sha256")), F.col("sha256")),
        entry(F.concat("name", F.lit("_schema_signature")), F.col("schema_sha256")),
    )
    fixed = F.array(*[entry(F.lit(k), F.lit(v)) for k, v in sorted((given or {}).items())])
    listed = F.flatten(F.collect_list(found))
    if given:
        listed = F.concat(listed, fixed)
    pairs = F.map_from_entries(F.array_sort(listed))
    return artifacts.groupBy("trade_date").agg(F.to_json(pairs).alias("provenance"))


def source_snapshot_hash(artifacts: DataFrame) -> DataFrame:
    """Hash per date over its provenance and its non-derived artifacts.

    ``artifacts`` may have a ``provenance`` text, one per date; without it, or where
    it is null, the provenance is empty.
    """
    entry = F.struct("name", "rows", "sha256")
    given = F.max("provenance") if "provenance" in artifacts.columns else F.lit(None)
    text = F.to_json(F.struct(
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        F.coalesce("_provenance", F.lit("{}")).alias("provenance"),
        F.col("artifacts").alias("artifacts"),
    ))
    return (
        artifacts.where(~F.col("name").isin(*DERIVED))
        .groupBy("trade_date")
        .agg(
            F.array_sort(F.collect_list(entry)).alias("artifacts"),
            given.cast("string").alias("_provenance"),
        )
        .select("trade_date", F.sha2(text, 256).alias("source_snapshot_sha256"))
    )


def _described(name: Column) -> Column:
    text = F.lit(OTHER_DESCRIPTION)
    for key, value in DESCRIPTIONS.items():
        text = F.when(name == key, value).otherwise(text)
    return text


def data_catalog(
    artifacts: DataFrame,
    state_rows: DataFrame,
    paths: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per dataset and date: layer, path, rows, hash, description.

    ``state_rows`` holds (trade_date, rows) of the derived state. ``paths`` gives the
    folder of a dataset's date where a store knows it.
    """
    day = F.date_format("trade_date", "yyyy-MM-dd")
    path = F.concat(F.lit("snapshots/"), day, F.lit("/"), F.col("name"))
    for name, known in (paths or {}).items():
        path = F.when(F.col("name") == name, known).otherwise(path)
    state_path = F.concat(F.lit("features/stock_state/trade_date="), day)
    snapshot = artifacts.where(~F.col("name").isin(*DERIVED)).select(
        "trade_date", "name", F.lit("snapshot").alias("layer"),
        path.alias("path"),
        F.col("rows").cast("bigint").alias("rows"), "sha256",
        _described(F.col("name")).alias("description"),
    )
    derived = state_rows.select(
        "trade_date", F.lit("stock_state").alias("name"),
        F.lit("derived_feature").alias("layer"),
        (paths or {}).get("stock_state", state_path).alias("path"),
        F.col("rows").cast("bigint").alias("rows"),
        F.lit(None).cast("string").alias("sha256"),
        F.lit(STATE_DESCRIPTION).alias("description"),
    )
    return snapshot.unionByName(derived)
