"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks: ranges of a hash of the document, so blocks are
random, about equal and need no shuffle. A source's target gives it whole epochs
over all its blocks and a part of a further one; the block that the target falls
into gives the documents that fit. The block quotas of all sources form one
vector. A tree halves the output shards again and again, and at each fork the left
half draws its blocks from the vector without replacement (multivariate
hypergeometric), so that shard quotas add up exactly. Each shard then takes
disjoint runs of the sources' hash-ordered blocks and is shuffled by itself.
"""

from __future__ import annotations

from itertools import cycle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, fresh, sheltered, ship, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SHARDS = 16
SEED = 17
#: Documents in a block, on average.
BLOCK_DOCS = 256
#: The plan holds a row per source on the driver; more sources are refused.
MAX_SOURCES = 100_000
#: A plan of so many sources (a few kB each) is broadcast; beyond, Spark joins it its own way.
BROADCAST_SOURCES = 2_000


def targets_of(sizes: list[int], weights: list[float], most: float = MAX_EPOCHS) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its source's size.

    What a capped source can't take is shared again by weight among the others.
    """
    size, weight = np.array(sizes, float), np.array(weights, float)
    target, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    while open_.any():
        rest = size.sum() - target[~open_].sum()
        share = rest * weight / weight[open_].sum()
        over = open_ & (share > most * size)
        target[open_] = share[open_]
        if not over.any():
            break
        target[over] = most * size[over]
        open_ &= ~over
    return [float(x) for x in target]


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Quotas of every shard (rows) and source (columns); columns sum to ``quotas``."""
    def split(have: np.ndarray, first: int, last: int) -> list[np.ndarray]:
        if last - first == 1:
            return [have]
        middle = (first + last) // 2
        take = int(have.sum()) * (middle - first) // (last - first)
        draw = np.random.default_rng([seed, first, last])
        left = draw.multivariate_hypergeometric(have, take, method="marginals")
        return split(left, first, middle) + split(have - left, middle, last)

    return np.array(split(np.array(quotas, np.int64), 0, shards))


def fill(docs: pd.DataFrame) -> pd.DataFrame:
    """Documents of a source's edge block, in hash order, that fit what its target leaves.

    The group is one block: about ``BLOCK_DOCS`` documents, repeats merged.
    """
    docs = docs.sort_values("u")
    left, more = float(docs["rest"].iloc[0] - docs["before"].iloc[0]), []
    least = None
    for u, size in zip(docs["u"], docs["size"], strict=True):
        if 0 < size <= left:
            more.append(u)
            left -= size
        elif size > 0 and (least is None or size < least[0]):
            least = (size, u)
    # One too many where that comes nearer.
    if least and least[0] < 2 * left:
        more.append(least[1])
    return pd.DataFrame({"k": [docs["k"].iloc[0]], "block": [int(docs["block"].iloc[0])], "more": [more]})


def mixing_plan(slim: DataFrame, weights: tuple[float, ...], most: int, shards: int, seed: int) -> tuple[DataFrame, int]:
    """One row per source: pk, source_size, target, epochs, blocks, last, more, shard_starts; and their number.

    ``slim`` is a written table of k (source key), size and u (hash as a number
    from 0 up to 1). Documents of the blocks before ``last``, and those of block
    ``last`` whose hash is in ``more``, are drawn once more than ``epochs``.
    """
    spark = slim.sparkSession
    ship(spark)
    sources = slim.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    rows = sources.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r.k is None, r.k or ""))
    wanted = targets_of([r.s for r in rows], [w for _, w in zip(rows, cycle(weights), strict=False)], most)
    plan = []
    for r, target in zip(rows, wanted, strict=True):
        epochs = min(most, int(target // r.s)) if r.s else 0
        plan.append((r.k, r.s, target, epochs, max(1, -(-r.n // BLOCK_DOCS)), target - epochs * r.s))
    kinds = "pk string, source_size long, target double, epochs int, blocks long, rest double"
    known = spark.createDataFrame(plan, kinds)

    # Where the rest ends: first its block, then the document in that block.
    block = F.least(F.floor(F.col("u") * F.col("blocks")), F.col("blocks") - 1)
    tagged = slim.join(known, F.col("k").eqNullSafe(F.col("pk"))).select("k", "size", "u", "rest", block.alias("block"))
    sums = tagged.groupBy("k", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    order = Window.partitionBy("k").orderBy("block")
    edge = (
        sums.withColumn("upto", F.sum("words").over(order))
        .where("words > 0 and upto - words < rest and upto >= rest")
        .select(F.col("k").alias("ek"), F.col("block").alias("eblock"), (F.col("upto") - F.col("words")).alias("before"))
    )
    inside = tagged.join(edge, F.col("k").eqNullSafe(F.col("ek")) & (F.col("block") == F.col("eblock")))
    inside = inside.groupBy("k", "u", "before", "rest", "block").agg(F.sum("size").alias("size"))
    ends = {r.k: (r.block, r.more) for r in inside.groupBy("k").applyInPandas(fill, "k string, block long, more array<double>").collect()}
    quotas = []
    for k, _, _, epochs, blocks, rest in plan:
        quotas.append(epochs * blocks + (ends[k][0] + 1 if k in ends else blocks if rest > 0 else 0))
    quota = split_quotas(quotas, shards, seed) if plan else np.zeros((shards, 0), np.int64)
    starts = np.cumsum(quota, axis=0) - quota
    done = []
    for i, (k, total, target, epochs, blocks, rest) in enumerate(plan):
        last, more = ends.get(k, (blocks if rest > 0 and total else 0, []))
        done.append((k, total, target, epochs, blocks, last, more, [int(x) for x in starts[1:, i]]))
    kinds = "pk string, source_size long, target double, epochs int, blocks long, last long, more array<double>, shard_starts array<long>"
    return spark.createDataFrame(done, kinds), len(done)


def draws(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS, shards: int = SHARDS, seed: int = SEED,
    slim: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target, copies and what draws them needs.

    ``slim`` keeps only the id. Size: words of the text, null counting as empty.
    Sources sort by code point, null last; weights repeat along them. Rows that
    repeat share a hash and so are drawn alike. An empty table gives no rows.
    """
    size, k, u = fresh(docs, "size", "k", "u")
    # The hash covers the text's length as well, so that equal ids don't all fall together.
    mix = F.xxhash64(F.lit(seed), at(id_col).cast("string"), at(source_col).cast("string"), F.length(at(text_col).cast("string")))
    unit = (F.shiftrightunsigned(mix, 11).cast("double") / F.lit(float(1 << 53)))
    tagged = docs.select(
        *([at(id_col)] if slim else [at(c) for c in docs.columns]),
        word_count(at(text_col).cast("string")).alias(size), at(source_col).cast("string").alias(k), unit.alias(u),
    )
    # Only ids and figures are written; whether a document is drawn follows from its hash.
    figures = [at(k).alias("k"), at(size).alias("size"), at(u).alias("u")]
    held = stage(tagged.select(*([at(id_col)] if slim else []), at(size), at(k), at(u)), "mix")
    plan, sources = mixing_plan(held.select(figures), weights, most, shards, seed)
    rows = held if slim else tagged
    plan = F.broadcast(plan) if sources <= BROADCAST_SOURCES else plan
    block = F.least(F.floor(at(u) * F.col("blocks")), F.col("blocks") - 1)
    once_more = ((block < F.col("last")) | F.array_contains("more", at(u))).cast("int")
    return rows.join(plan, at(k).eqNullSafe(F.col("pk")), "left").select(
        *[at(c) for c in ([id_col] if slim else docs.columns)],
        at(size).alias("__size"), at(u).alias("__u"), F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"), F.col("blocks").alias("__blocks"),
        F.col("shard_starts").alias("__starts"), (F.col("epochs") + once_more).alias("__copies"),
    )


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Per row: the id, size, source_size, target, taken (words, repeats counted)."""
    return draws(docs, id_col, text_col, source_col, slim=True, **options).select(
        at(id_col), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"),
    )


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    seed: int = SEED, shards: int = SHARDS, shard_col: str | None = None, **options,
) -> DataFrame:
    """The mixture: columns of ``docs``, a row per draw, dealt to shards and shuffled in each.

    The draw of epoch e from block b of a source is number e * blocks + b; the
    shard is the one whose run of numbers holds it. ``shard_col`` adds the shard.
    Columns may have any names.
    """
    def work(rows: DataFrame, i: str, t: str, s: str) -> DataFrame:
        return _mixed(rows, i, t, s, seed, shards, "shard" if shard_col else None, **options)

    return sheltered(docs, [id_col, text_col, source_col], work, [shard_col] if shard_col else [])


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, shards: int, shard_col: str | None, **options) -> DataFrame:
    drawn = draws(docs, id_col, text_col, source_col, seed=seed, shards=shards, **options)
    names = [at(c) for c in docs.columns]
    block = F.least(F.floor(F.col("__u") * F.col("__blocks")), F.col("__blocks") - 1)
    epochs = F.when(F.col("__copies") > 0, F.sequence(F.lit(0), F.col("__copies") - 1)).otherwise(F.array().cast("array<int>"))
    rows = drawn.withColumn("__epoch", F.explode(epochs)).withColumn("__draw", F.col("__epoch") * F.col("__blocks") + block)
    shard = F.size(F.filter("__starts", lambda s: s <= F.col("__draw")))
    rows = rows.withColumn("__shard", shard).withColumn("__order", F.xxhash64(F.lit(seed), "__u", "__epoch", F.lit("order")))
    # A shard takes several tasks when it is large; its order is by hash all along.
    tasks = F.pmod(F.shiftrightunsigned("__order", 32), F.lit(64))
    rows = rows.repartition("__shard", tasks).sortWithinPartitions("__shard", "__order")
    return rows.select(*names, *([F.col("__shard").alias(shard_col)] if shard_col else []))
