"""Multi-party chat formatting: one rendering per participant.

A dialogue is rendered once for each of its speakers: that speaker's turns become
the assistant's, everyone else's become named users', and the mask marks what the
assistant is trained on. Turns come in parts of ``MAX_TURNS`` consecutive turn
numbers, so no group grows with a conversation; every speaker of the conversation
gets every part, and the parts joined are the rendering of the whole dialogue. All
of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage

#: Turn numbers in a part.
MAX_TURNS = 64
#: Roles that set the scene rather than speak.
CONTEXT = ("system",)
#: Speaker of turns without a role.
UNNAMED = "unknown"
#: Reducers that a conversation's pieces are dealt to when they meet its speakers.
SPREAD = 16
#: The markers of the rendered text.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"


def plain(text: Column) -> Column:
    """Text that can't be taken for a marker."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def parts(turns: DataFrame, max_turns: int) -> DataFrame:
    """Turns with part and piece: a part of over twice as many rows as numbers is cut into pieces.

    Only turn numbers that repeat, or are missing, fill a part that far. Its rows get
    places by the total order (turn, role, body), and a piece is a run of ``max_turns``
    consecutive places; so no turn is moved, and the cut doesn't depend on how the
    table lies.
    """
    rows = turns.withColumn("part", F.floor(F.col("turn") / max_turns).cast("long"))
    full = stage(
        rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 2 * max_turns), "full"
    ).toDF("f_conv", "f_part", "f_rows")
    names = ["conv_id", "part", "turn", "role", "body"]
    first = F.lit(0).cast("long").alias("piece")
    if full.isEmpty():
        return rows.select(*names, first)
    marked = rows.join(full, F.col("conv_id").eqNullSafe(F.col("f_conv")) & F.col("part").eqNullSafe(F.col("f_part")), "left")
    return marked.where("f_rows is null").select(*names, first).unionByName(
        consecutive(marked.where("f_rows is not null").select(*names), names, max_turns)
    )


def consecutive(rows: DataFrame, names: list[str], size: int) -> DataFrame:
    """``rows`` with piece: their places in the order of ``names`` within (conv_id, part), by ``size``.

    Equal rows are counted before the sort. Ranges of the sort number their own rows,
    and each starts where the ones before it end.
    """
    same = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    held = stage(same.repartitionByRange(*names).sortWithinPartitions(*names).withColumns(
        {"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}
    ), "ranges")
    sums = held.groupBy("conv_id", "part", "range").agg(F.sum("copies").alias("n"))
    starts = sums.select(
        F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part"), F.col("range").alias("s_range"),
        (F.sum("n").over(Window.partitionBy("conv_id", "part").orderBy("range")) - F.col("n")).alias("start"),
    )
    inside = Window.partitionBy("conv_id", "part", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = held.withColumn("upto", F.sum("copies").over(inside)).join(
        starts, F.col("conv_id").eqNullSafe(F.col("s_conv")) & F.col("part").eqNullSafe(F.col("s_part"))
        & (F.col("range") == F.col("s_range")),
    ).withColumn("upto", F.col("upto") + F.col("start")).withColumn("from", F.col("upto") - F.col("copies"))
    piece = F.sequence(F.floor(F.col("from") / size).cast("long"), F.floor((F.col("upto") - 1) / size).cast("long"))
    cut = placed.withColumn("piece", F.explode(piece))
    there = F.least("upto", (F.col("piece") + 1) * size) - F.greatest("from", F.col("piece") * size)
    return cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), there))).select(*names, "piece")


def speakers_of_several(rows: DataFrame, context: tuple[str, ...]) -> DataFrame:
    """Speakers (s_conv, speaker) of the conversations that have more than one part or piece."""
    several = stage(rows.groupBy("conv_id").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.count("part").alias("numbered"),
        F.count(F.lit(1)).alias("n"), F.max("piece").alias("pieces"),
    ).where("low < high or pieces > 0 or (numbered > 0 and numbered < n)").select(F.col("conv_id").alias("l_conv")), "several")
    spoken = rows.where(~F.col("role").isin(*context)).select("conv_id", "role").distinct()
    found = spoken.join(several, F.col("conv_id").eqNullSafe(F.col("l_conv")), "left_semi")
    return stage(found.select(F.col("conv_id").alias("s_conv"), F.col("role").alias("s_role")), "speakers")


def dialogues(turns: DataFrame, max_turns: int = MAX_TURNS, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """Per conversation, speaker, part and piece: text, mask and counts.

    ``turns``: conv_id, turn, role, text; other columns are ignored. Turns are
    ordered by number, role, text, nulls first. Each speaker of a conversation gets
    all its parts, silent or not: the texts joined by part (null first) and piece are
    the whole dialogue. mask: spans (start, end) of characters of the row's text, the
    assistant's words with their end marker; ``with_offset`` says where a row begins
    in the whole. A conversation without speakers gives no row; a null text is an
    empty turn; a null role is ``unknown``; repeated rows are repeated turns.
    """
    role = F.coalesce(F.translate(plain(F.col("role")), NEWLINE, " "), F.lit(""))
    rows = parts(turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.when(role == "", F.lit(UNNAMED)).otherwise(role).alias("role"), plain(F.col("text")).alias("body"),
    ), max_turns)
    spoken = rows.groupBy("conv_id", "part", "piece").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "body"))).alias("turns")
    )
    # A conversation of one piece has its speakers there; those of others are looked up.
    spoken = spoken.withColumn("salt", F.pmod(F.xxhash64("part", "piece"), F.lit(SPREAD)))
    known = speakers_of_several(rows, context).withColumn(
        "s_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    there = F.array_except(F.transform("turns", lambda m: m["role"]), F.array(*[F.lit(c) for c in context]))
    each = spoken.join(
        known, F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("salt") == F.col("s_salt")), "left"
    ).withColumn("speaker", F.explode(F.when(F.col("s_role").isNotNull(), F.array("s_role")).otherwise(F.array_distinct(there))))

    def head(m: Column) -> Column:
        return (
            F.when(m["role"] == F.col("speaker"), F.lit(f"{START}assistant{NEWLINE}"))
            .when(m["role"].isin(*context), F.lit(f"{START}system{NEWLINE}"))
            .otherwise(F.concat(F.lit(f"{START}user name="), m["role"], F.lit(NEWLINE)))
        )

    each = each.withColumn("said", F.transform("turns", lambda m: F.struct(
        head(m).alias("head"), m["body"].alias("body"), (m["role"] == F.col("speaker")).alias("target"))))
    tail = len(END) + len(NEWLINE)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, m: Column) -> Column:
        first = acc["at"] + F.length(m["head"])
        last = first + F.length(m["body"])
        span = F.array(F.struct(first.alias("start"), (last + len(END)).alias("end")))
        return F.struct(
            (last + tail).alias("at"),
            F.when(m["target"], F.concat(acc["mask"], span)).otherwise(acc["mask"]).alias("mask"),
        )

    masked = F.aggregate("said", F.struct(F.lit(0).alias("at"), empty.alias("mask")), step, lambda acc: acc["mask"])
    return each.select(
        "conv_id", "part", "piece", "speaker",
        F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("said", lambda m: m["target"])).cast("long").alias("n_target_turns"),
        F.array_join(F.transform("said", lambda m: F.concat(m["head"], m["body"], F.lit(END + NEWLINE))), "").alias("text"),
        masked.alias("mask"),
    )


def perspectives(turns: DataFrame, **options) -> DataFrame:
    """``dialogues`` without the rows in which the speaker is silent."""
    return dialogues(turns, **options).where("n_target_turns > 0")


def with_offset(rendered: DataFrame) -> DataFrame:
    """``dialogues`` with offset: the character of the speaker's whole rendering where the row begins."""
    keys = ["conv_id", "speaker", "part", "piece"]
    # Only numbers meet in a window, so a long conversation's texts stay apart.
    before = Window.partitionBy("conv_id", "speaker").orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rendered.select(*keys, F.length("text").cast("long").alias("size"))
    begins = sizes.select(
        *[F.col(k).alias(f"b_{k}") for k in keys], F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")
    )
    same = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys]
    return rendered.join(begins, same).select(*rendered.columns, "offset")


def digests(turns: DataFrame, **options) -> DataFrame:
    """``dialogues`` with the mask as text: start-end,start-end."""
    span = F.transform("mask", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return dialogues(turns, **options).withColumn("mask", F.array_join(span, ","))


SQL = """
    WITH m AS (
        SELECT conv_id, CAST(floor(turn / 64) AS BIGINT) AS part, turn,
               CASE WHEN coalesce(role, '') = '' THEN 'unknown'
                    ELSE replace(replace(role, '<|', '< |'), chr(10), ' ') END AS role,
               replace(coalesce(text, ''), '<|', '< |') AS body
        FROM conversations
    ), n AS (
        SELECT *, CASE WHEN count(*) OVER (PARTITION BY conv_id, part) > 128
                       THEN (row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, body) - 1) // 64
                       ELSE 0 END AS piece
        FROM m
    ), s AS (
        SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'
    ), r AS (
        SELECT n.conv_id, n.part, n.piece, s.speaker, n.turn, n.role, n.body, n.role = s.speaker AS target,
               CASE WHEN n.role = s.speaker THEN '<|im_start|>assistant' || chr(10)
                    WHEN n.role = 'system' THEN '<|im_start|>system' || chr(10)
                    ELSE '<|im_start|>user name=' || n.role || chr(10) END AS head
        FROM s JOIN n ON s.conv_id IS NOT DISTINCT FROM n.conv_id
    ), p AS (
        SELECT *, sum(length(head) + length(body) + 11) OVER (
                   PARTITION BY conv_id, part, piece, speaker
                   ORDER BY turn NULLS FIRST, role, body ROWS UNBOUNDED PRECEDING
               ) - length(body) - 11 AS begins
        FROM r
    )
    SELECT conv_id, part, CAST(piece AS BIGINT) AS piece, speaker, count(*) AS n_turns,
           count(*) FILTER (target) AS n_target_turns,
           string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, body) AS text,
           coalesce(string_agg(CAST(begins AS BIGINT) || '-' || CAST(begins + length(body) + 10 AS BIGINT), ','
                               ORDER BY turn NULLS FIRST, role, body) FILTER (target), '') AS mask
    FROM p GROUP BY conv_id, part, piece, speaker
"""
