"""Exact duplicates by a heavy-hitter split.

A Misra-Gries sketch (Spark's frequent-items aggregate) names the digests that
may be frequent. Their groups are then counted exactly and the verified winners,
at most ``max_heavy`` rows, are broadcast: copies of a frequent text are removed
map-side and never meet in one task. All other digests are shuffled once. The
sketch only decides which way a digest goes, so it can't change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, fresh, sheltered

#: At most so many digests take the map-side way: a broadcast of some 100 kB.
MAX_HEAVY = 1000
#: Counters of the sketch; a digest with more than about rows / TRACKED copies has one.
TRACKED = 10_000


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes in lowercase hex; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def verified_winners(rows: DataFrame, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """Frequent digests with exact size and winner: sha, size, best (id, row).

    ``rows`` has sha, id and row; only digests found at least twice are returned.
    """
    sketch = rows.agg(F.expr(f"approx_top_k(sha, {max_heavy}, {TRACKED})").alias("top"))
    names = sketch.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("sha"))
    return (
        rows.join(F.broadcast(names), "sha", "left_semi")
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "row")).alias("best"))
        .where("size > 1")
    )


def duplicate_groups(rows: DataFrame, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """Adds size and best to each of ``rows`` (sha, id, row), a written table."""
    winners = verified_winners(rows, max_heavy)
    tagged = rows.join(F.broadcast(winners), "sha", "left")
    group = Window.partitionBy("sha")
    light = tagged.where("size is null").select(
        "sha", "id", "row",
        F.count(F.lit(1)).over(group).alias("size"),
        F.max(F.struct("id", "row")).over(group).alias("best"),
    )
    return tagged.where("size is not null").select("sha", "id", "row", "size", "best").unionByName(light)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_heavy: int = MAX_HEAVY
) -> DataFrame:
    """One row per input row: the id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group; null and empty texts are equal. The row with the
    largest id stays. Null ids are smallest; of rows that repeat an id and text,
    one stays. Other columns are ignored; an empty table gives an empty result.
    """
    rows = stage(
        docs.select(at(id_col).alias("id"), digest(at(text_col)).alias("sha"),
                    F.monotonically_increasing_id().alias("row")),
        "digests",
    )
    return duplicate_groups(rows, max_heavy).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_heavy: int = MAX_HEAVY
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, by the rule of ``exact_duplicates``.

    Copies of frequent texts go map-side. The others' losers are found on ids and
    digests alone, written, and taken out by an anti join that Spark broadcasts
    only when the written table is small. Columns may have any names.
    """
    work = lambda rows, i, t: _without_duplicates(rows, i, t, max_heavy)
    return sheltered(docs, [id_col, text_col], work)


def _without_duplicates(docs: DataFrame, id_col: str, text_col: str, max_heavy: int) -> DataFrame:
    sha, row = fresh(docs, "sha", "row")
    held = stage(docs.withColumns({sha: digest(at(text_col)), row: F.monotonically_increasing_id()}), "dedup")
    rows = held.select(at(id_col).alias("id"), at(sha).alias("sha"), at(row).alias("row"))
    winners = stage(verified_winners(rows, max_heavy), "winners")
    heavy = F.broadcast(winners.select(F.col("sha").alias(sha), F.col("best.row").alias("__best")))
    group = Window.partitionBy("sha")
    losers = stage(
        rows.join(F.broadcast(winners.select("sha")), "sha", "left_anti")
        .select("row", F.max(F.struct("id", "row")).over(group).alias("best"))
        .where("row != best.row")
        .select(F.col("row").alias(row)),
        "losers",
    )
    return (
        held.join(heavy, sha, "left")
        .where(F.col("__best").isNull() | (at(row) == F.col("__best")))
        .join(losers, row, "left_anti")
        .select([at(c) for c in docs.columns])
    )
