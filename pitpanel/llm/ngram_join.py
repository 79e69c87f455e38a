"""N-gram Jaccard join with PartEnum signatures.

A text is the set of its five-word shingles. Two sets of sizes a <= b with
Jaccard similarity of at least 4/5 differ in at most (a + b) / 9 <= min(a / 4,
2 b / 9) shingles. Sizes fall into bands that double; a band's shape (n1, n2, k2)
cuts the hash domain into n1 parts of n2 cells each, and a set's signatures are
the contents of all subsets of n2 - k2 cells of a part. At most k // (k2 + 1)
parts can have more than k2 differences, so similar sets share a signature. A set
also signs in the band below when a smaller partner may be there.

Empty contents are no signatures: a set needs one usable part more than its
differences can spoil. The few sets that have fewer sign their empty parts too,
but only for each other. Of a set's contents in the order of their hashes, those
beyond what its differences can spoil and a reserve aren't signed: similar sets
share some of the first ones, and as many more as the reserve has. Contents that
more than ``COMMON`` sets sign (passages) are dropped by every set whose reserve
covers them, which loses no pair; only sets made of little else keep them. So no
signature's group grows with a passage, and a chance meeting in a few signatures is
no candidate: similar sets share at least one more than what is left of the reserve.

Sets of one signature are first checked against their smallest member: near copies
become one component by a linear number of checks. Only what is still apart is
paired. A parity sketch of every set goes along: two sets differ at least in as many
shingles as their sketches do in bits, so dissimilar variants of one text fail the
join's own condition and are never pairs. Every pair is checked exactly on the sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, comb, exp, sqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, chunks, sheltered, ship

WORDS = 5
#: Similarity as a fraction; the bounds on differences in this module are for it.
NUMERATOR, DENOMINATOR = 80, 100
#: A signature of more sets than this is common.
COMMON = 50
#: Signatures so frequent that they are taken out before the shuffle (at most so many).
MAX_HEAVY, TRACKED = 1000, 50_000
#: Band exponents whose parts have three cells, of which any two are signed.
ENUMERATED = (6,)
#: Usable parts beyond what is needed, by cells a part: standard deviations and a factor.
SPARE_SD, SPARE = {1: 4.0, 3: 2.5}, {1: 1.12, 3: 1.05}
#: Signatures beyond the needed ones, as a share of these: to be shared by similar
#: sets, and to make up for common ones.
RESERVE, SLACK = 0.06, 0.06
#: Words of 64 bits in a set's parity sketch.
SKETCH = 8
#: Entries of a task's word-hash memo.
MEMO = 1 << 18

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; ASCII letters count as lower case."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(w) < WORDS:
            # Its length keeps a short sequence apart from every shingle.
            return mixed(np.array([(w * _ODD[: len(w)]).sum() + np.uint64(len(w))], np.uint64))
        n = len(w) - WORDS + 1
        total = w[:n] * _ODD[0]
        for i in range(1, WORDS):
            total += w[i : i + n] * _ODD[i]
    return np.unique(mixed(total))


def usable_parts(size: int, n1: int, n2: int, k2: int) -> tuple[float, float]:
    """Mean and standard deviation of a set's usable parts: at most ``k2`` empty cells of ``n2``."""
    if n2 == 1:
        none, pair = (1 - 1 / n1) ** size, (1 - 2 / n1) ** size if n1 > 1 else 0.0
        variance = n1 * (n1 - 1) * pair + n1 * none - (n1 * none) ** 2
        return n1 * (1 - none), sqrt(max(0.0, variance))
    e = exp(-size / n1 / n2)
    p = sum(comb(n2, i) * e**i * (1 - e) ** (n2 - i) for i in range(k2 + 1))
    # Full parts make others emptier, so this is not too small.
    return n1 * p, sqrt(n1 * p * (1 - p))


@lru_cache
def shape(band: int) -> tuple[int, int, int]:
    """(n1, n2, k2) of the sizes from 2 ** band to 2 ** (band + 1) - 1.

    n1 is the least number of parts that leaves nearly every set of these sizes,
    and larger ones that sign here, enough usable parts.
    """
    n2, k2 = (3, 1) if band in ENUMERATED else (1, 0)
    top = 2 ** (band + 1) - 1
    cases = [(top, top // 4), (top * 5 // 4, 2 * (top * 5 // 4) // 9)]
    n1 = max(1, top // 8)
    while any(
        mean - SPARE_SD[n2] * deviation < SPARE[n2] * (k // (k2 + 1) + 1)
        for size, k in cases
        for mean, deviation in [usable_parts(size, n1, n2, k2)]
    ):
        n1 += max(1, n1 // 50)
    return n1, n2, k2


class Signed(NamedTuple):
    """Signatures of a set in a band, and how many it could lack and still share one ..."""

    sigs: np.ndarray
    spare: int
    reserve: int
    """... or share more than this many; signatures of the parts that are no use."""
    other: np.ndarray


def signed(s: np.ndarray, band: int, differences: int) -> Signed:
    """What a set signs in a band when a partner may differ in so many shingles."""
    n1, n2, k2 = shape(band)
    with np.errstate(over="ignore"):
        part = (s >> np.uint64(32)) * np.uint64(n1) >> np.uint64(32)
        value = mixed(s + np.uint64(band + 1) * _ODD[1])
        if n2 == 1:
            # Sorted sets are sorted by part.
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            full = part[first].astype(np.int64)
            sums = np.add.reduceat(value, first)
            sigs = np.sort(mixed(sums + part[first] * _ODD[2] + np.uint64(band) * _ODD[3]))
            needed = differences + 1
            reserve = ceil(RESERVE * (2**band // 4 + 1))  # the same for all sets of a band
            usable = min(len(sigs), needed + reserve + ceil(SLACK * needed) + 2)
            sigs = sigs[:usable]
            other = np.zeros(0, np.uint64)
            if usable < needed:
                bare = np.setdiff1d(np.arange(n1), full).astype(np.uint64)
                other = mixed(bare * _ODD[2] + np.uint64(band) * _ODD[4])
        else:
            cell = (part * np.uint64(n2) + ((s & np.uint64(0xFFFFFFFF)) * np.uint64(n2) >> np.uint64(32))).astype(np.int64)
            sums = np.zeros(n1 * n2, np.uint64)
            np.add.at(sums, cell, value)
            there = np.bincount(cell, minlength=n1 * n2).reshape(n1, n2) > 0
            sums = sums.reshape(n1, n2)
            out, full = [], []
            for i, cells in enumerate(combinations(range(n2), n2 - k2)):
                content = mixed(sums[:, cells].sum(axis=1, dtype=np.uint64) + np.uint64(i + 1) * _ODD[4])
                out.append(mixed(content + np.arange(n1, dtype=np.uint64) * _ODD[2] + np.uint64(band) * _ODD[3]))
                full.append(there[:, cells].any(axis=1))
            out, full = np.stack(out), np.stack(full)
            usable, needed, reserve = int(full.all(axis=0).sum()), differences // (k2 + 1) + 1, 1
            sigs, other = out[full], out[~full] if usable < needed else np.zeros(0, np.uint64)
    return Signed(sigs, usable - needed, reserve, other)


def signatures(s: np.ndarray) -> tuple[np.ndarray, int, int, int]:
    """All signatures of a set, how many common ones it can do without, how many when
    it is still to share a reserve, and that reserve.

    Sets with fewer than 4 shingles are similar to equal sets only and sign nothing.
    """
    n = len(s)
    if n < 4:
        return np.zeros(0, np.uint64), 0, 0, 0
    band = n.bit_length() - 1
    parts = [signed(s, band, n // 4)]
    # A partner of the band below has at most 2 ** band - 1 and at least 4 n / 5 shingles.
    if 5 * (2**band - 1) >= 4 * n and 2**band - 1 >= 4:
        parts.append(signed(s, band - 1, 2 * n // 9))
    sigs = np.concatenate([x for p in parts for x in (p.sigs, p.other)])
    return sigs, min(p.spare for p in parts), min(p.spare - p.reserve for p in parts), min(p.reserve for p in parts)


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """One bit per cell of the hash domain: whether the set has an odd number of shingles there."""
    odd = np.bincount(((s >> np.uint64(17)) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sets_of(docs: DataFrame) -> DataFrame:
    """Per row of (key, text): key and its shingle set as an array."""
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            done = 0
            for part in chunks(batch["text"]):
                sets = [shingle_set(text, hashes).view(np.int64) for text in part]
                yield pd.DataFrame({"rep": batch["rep"].to_numpy()[done : done + len(part)], "s": sets})
                done += len(part)

    return docs.select("rep", "text").mapInPandas(build, "rep long, s array<long>")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar: an exact check."""
    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
    both = both.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
    same = F.size(F.array_intersect("sa", "sb"))
    return both.where(DENOMINATOR * same >= NUMERATOR * (F.size("sa") + F.size("sb") - same)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of ``edges`` (a, b): node, root.

    Alternating large and small stars; each round is written and read again.
    """
    edges = stage(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        after = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u != v").distinct()
        )
        after = stage(after, "edges")
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def shared_signatures(sets: DataFrame) -> DataFrame:
    """Signatures that may make a pair: sig, row, left (what is left of the row's reserve).

    The most frequent signatures, found by a sketch, are counted map-side; the
    others are shuffled once. Common ones are left to rows that can't spare them.
    A row that keeps its reserve has, with another such row, more than the reserve
    in common; where it shares fewer with anyone, it stays only for poorer rows.
    """
    rows = sets.select("row", F.explode("sigs").alias("sig"))
    sketch = rows.agg(F.expr(f"approx_top_k(sig, {MAX_HEAVY}, {TRACKED})").alias("top"))
    heavy = sketch.select(F.explode("top").alias("t")).where(F.col("t.count") > 20 * COMMON).select(F.col("t.item").alias("sig"))
    heavy = stage(
        rows.join(F.broadcast(heavy), "sig", "left_semi").groupBy("sig").agg(F.count(F.lit(1)).alias("many")), "heavy"
    )
    counted = F.broadcast(heavy)  # at most MAX_HEAVY rows
    light = rows.join(counted, "sig", "left_anti").select(
        "sig", "row", F.count(F.lit(1)).over(Window.partitionBy("sig")).alias("many")
    ).where("many > 1")
    many = light.unionByName(rows.join(counted, "sig").select("sig", "row", "many").where("many > 1"))
    many = stage(many.select("sig", "row", (F.col("many") > COMMON).alias("common")), "shared")
    state = (
        many.groupBy("row").agg(F.count_if("common").alias("lost"), F.count_if(~F.col("common")).alias("shares"))
        .join(sets.select("row", "spare", "rich", "reserve"), "row")
        .select(
            "row", (F.col("lost") <= F.col("spare")).alias("spares"), (F.col("lost") <= F.col("rich")).alias("rich"),
            ((F.col("lost") <= F.col("rich")) & (F.col("shares") <= F.col("reserve"))).alias("alone"),
            F.greatest(F.col("spare") - F.col("lost"), F.lit(0)).cast("int").alias("left"),
        )
    )
    state = stage(state, "state")
    known = many.join(state, "row").where(~(F.col("common") & F.col("spares")))
    poor = stage(known.where(~F.col("rich")).select("sig").distinct(), "poor")
    able = known.where(~F.col("alone")).select("sig", "row", "left")
    alone = known.where("alone").join(poor, "sig", "left_semi").select("sig", "row", "left")
    return able.unionByName(alone)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, text_key, n, row, root, low_id, a written table.

    root is the row that stands for the group of rows linked directly or in steps;
    low_id the smallest id of the group. Rows without words stand alone.
    """
    ship(docs.sparkSession)
    ids = docs.select(at(id_col).alias("id"), at(text_col).cast("string").alias("text"))
    numbered = ids.withColumn("row", F.monotonically_increasing_id())
    held = stage(
        numbered.select("row", "id", F.xxhash64("text").alias("text_key"), "text").transform(with_descriptions),
        "sets",
    )
    return grouped(ids, held)


def with_descriptions(rows: DataFrame) -> DataFrame:
    """Rows of (row, id, text_key, text) without the text, with n, digest, spare, rich, reserve, sigs."""
    @F.pandas_udf("n long, digest binary, spare int, rich int, reserve int, sigs array<long>, sketch array<long>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for texts in batches:
            out = []
            for part in chunks(texts):
                for text in part:
                    s = shingle_set(text, hashes)
                    sigs, *spare = signatures(s)
                    out.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None, *spare, sigs.view(np.int64), parity_sketch(s)))
            yield pd.DataFrame(out, columns=["n", "digest", "spare", "rich", "reserve", "sigs", "sketch"])

    return rows.withColumn("d", describe("text")).select(
        "row", "id", "text_key", "d.*", *[F.get("d.sketch", F.lit(i)).alias(f"k{i}") for i in range(SKETCH)]
    ).drop("sketch")


def grouped(ids: DataFrame, held: DataFrame) -> DataFrame:
    """``similar_groups`` from the written descriptions ``held`` of the rows ``ids``."""
    # Equal sets are one class; the least row stands for it.
    classes = stage(
        held.where("n > 0").groupBy("digest").agg(
            F.min("row").alias("rep"), F.min("id").alias("low_id"), F.min("n").alias("n"),
            F.min(F.struct("row", "id", "text_key")).alias("first"),
        ),
        "classes",
    )
    sketch = [f"k{i}" for i in range(SKETCH)]
    member = held.where("n >= 4").select("row", "digest", "n", *sketch).join(classes.select("digest", "rep"), "digest").drop("digest")
    shared = stage(shared_signatures(held.select("row", "spare", "rich", "reserve", "sigs")), "signed")

    # First checks: everyone against the smallest of its signature, where they share several.
    low = F.min("row").over(Window.partitionBy("sig"))
    stars = shared.withColumn("low", low).where("row != low").groupBy("row", "low").agg(
        F.count(F.lit(1)).alias("common"), F.first("left").alias("left")
    )
    stars = stage(as_pairs(stars.where("2 * common > left"), member), "stars")
    sets = stage(sets_for(stars, ids, classes), "checked")
    edges = stage(linked(stars, sets), "links")
    roots = stage(components(edges), "roots")

    # Second checks: pairs that are still apart, weren't checked, and share enough.
    named = (
        shared.join(member, "row").join(roots, F.col("rep") == F.col("node"), "left")
        .select("sig", "rep", "n", "left", F.coalesce("root", "rep").alias("root"), *sketch)
    )
    apart = named.groupBy("sig").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("sig")
    named = stage(named.join(apart, "sig", "left_semi").distinct(), "apart")
    one, two = (
        named.withColumnsRenamed({"rep": x, "n": f"n{x}", "root": f"r{x}", "left": f"l{x}"} | {k: f"{x}{k}" for k in sketch})
        for x in "ab"
    )
    rest = one.join(two, "sig").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & near("a", "b"))
    rest = rest.groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"), F.first(F.least("la", "lb")).alias("left"))
    rest = stage(rest.where("common > left").select("a", "b").join(stars, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stage(sets_for(rest, ids, classes), "checked")
        edges = edges.unionByName(linked(rest, more))
        roots = stage(components(edges), "roots")

    named = classes.join(roots, F.col("rep") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rep"))
    low = named.groupBy("root").agg(F.min("low_id").alias("low"))
    classes = named.select("digest", "root").join(low, "root")
    return (
        held.select("row", "id", "text_key", "n", "digest").join(classes, "digest", "left")
        .select("row", "id", "text_key", "n", F.coalesce("root", "row").alias("root"), F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("id")).alias("low_id"))
    )


def near(x: str, y: str) -> Column:
    """Whether sets may be similar by their sizes (nx, ny) and sketches (xk0, yk0, ...)."""
    a, b = F.col(f"n{x}"), F.col(f"n{y}")
    bits = [F.bit_count(F.col(f"{x}k{i}").bitwiseXOR(F.col(f"{y}k{i}"))) for i in range(SKETCH)]
    # Sets of similarity 4/5 differ in at most (a + b) / 9 shingles.
    return (DENOMINATOR * F.least(a, b) >= NUMERATOR * F.greatest(a, b)) & (9 * reduce(lambda p, q: p + q, bits) <= a + b)


def as_pairs(rows: DataFrame, member: DataFrame) -> DataFrame:
    """Pairs of rows as distinct pairs of their classes, a < b, that may be similar."""
    renamed = lambda x, row: member.withColumnsRenamed(
        {"row": row, "rep": x, "n": f"n{x}"} | {f"k{i}": f"{x}k{i}" for i in range(SKETCH)}
    )
    both = rows.join(renamed("x", "row"), "row").join(renamed("y", "low"), "low")
    both = both.where((F.col("x") != F.col("y")) & near("x", "y"))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def sets_for(pairs: DataFrame, ids: DataFrame, classes: DataFrame) -> DataFrame:
    """Sets of all classes in ``pairs``, from the text of one row of each.

    Texts are read again rather than kept: only few classes are in a pair. The
    wanted rows are written first, so Spark broadcasts them only if they are small.
    """
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    wanted = stage(
        wanted.join(classes, "rep").select("rep", F.col("first.id").alias("wid"), F.col("first.text_key").alias("wkey")), "wanted"
    )
    keyed = ids.withColumn("tkey", F.xxhash64("text"))
    found = keyed.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("tkey") == F.col("wkey"))).select("rep", "text")
    # Rows may repeat: one of each is enough.
    once = F.row_number().over(Window.partitionBy("rep").orderBy("rep"))
    return sets_of(found.withColumn("i", once).where("i = 1"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: the smallest id of every group.

    Rows are told apart by id and text, so texts aren't written again; of rows
    that repeat both, one stays. Columns may have any names.
    """
    return sheltered(docs, [id_col, text_col], _without_near_duplicates)


def _without_near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    groups = stage(similar_groups(docs, id_col, text_col), "groups")
    best = groups.groupBy("root").agg(F.min(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    named = groups.join(best, "root").select("id", "text_key", (F.col("row") == F.col("best.row")).alias("stays"))
    keys = stage(
        named.groupBy("id", "text_key").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows")).where("rows > 1 or not stays"),
        "losers",
    ).withColumnsRenamed({"id": "__id", "text_key": "__key", "stays": "__stays"})
    same = at(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(at(text_col).cast("string")) == F.col("__key"))
    names = [at(c) for c in docs.columns]
    kept = docs.join(keys, same, "left_anti").select(names)
    repeated = keys.where("__stays")
    if repeated.isEmpty():
        return kept
    once = F.row_number().over(Window.partitionBy("__id", "__key").orderBy("__key"))
    return kept.unionByName(docs.join(repeated, same).withColumn("__i", once).where("__i = 1").select(names))
