"""Nearest vectors by a forest of hash prefixes.

A vector's string in a tree is the signs of its projections on random directions,
32 of them. A tree is the sorted array of its strings: the vectors that share a
prefix with a query are a run of it. A query descends every tree to its longest
match and then ascends all trees together, one character at a time, until enough
vectors share a prefix with it in some tree. These are measured exactly.

How many are enough is fitted: a bounded sample is searched both ways, and the
least share of the rows that finds ``TARGET`` of the true neighbours is used. Rows
are dealt by hash into blocks of bounded size, each with its own forest; queries go
to every block in chunks, and only each block's nearest come back. So equal or
clustered vectors load all blocks alike and nothing is broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, ship

NEAREST = 10
TREES, CHARACTERS = 64, 32
SEED = 11
#: Rows of a block and queries of a chunk, on average.
BLOCK_ROWS, CHUNK_QUERIES = 8192, 2048
#: Vectors and queries of the sample that the stop rule is fitted on.
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 64
#: Share of true neighbours that the stop rule has to find on the sample.
TARGET = 0.97
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def strings(x: np.ndarray, centre: np.ndarray, tree: int) -> np.ndarray:
    """A tree's strings as whole numbers, the first character in the highest bit."""
    directions = np.random.default_rng([SEED, tree, x.shape[1]]).standard_normal((x.shape[1], CHARACTERS))
    bits = (x - centre) @ directions > 0
    return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(CHARACTERS - 1, -1, -1, dtype=np.uint64))


class Forest:
    """Sorted arrays of the strings of one block of vectors."""

    def __init__(self, x: np.ndarray, centre: np.ndarray):
        self.x, self.centre = x, centre
        keys = [strings(x, centre, t) for t in range(TREES)]
        self.order = [np.argsort(k, kind="stable") for k in keys]
        self.keys = [k[o] for k, o in zip(keys, self.order, strict=True)]

    def ascend(self, queries: np.ndarray, share: float, k: int = NEAREST, own: np.ndarray | None = None):
        """Per query: numbers of the vectors met when at least ``share`` of the block is met.

        ``own`` counts the rows of each query's own id in the block: they come on top,
        since they are no neighbours.
        """
        n = len(self.x)
        least = max(k + 1, int(np.ceil(share * n)))
        wanted = np.minimum(n, least + (np.zeros(len(queries), np.int64) if own is None else own))
        asked = [strings(queries, self.centre, t) for t in range(TREES)]
        lows = np.zeros((CHARACTERS + 1, TREES, len(queries)), np.int64)
        highs = np.zeros_like(lows)
        for level in range(CHARACTERS + 1):
            shift = np.uint64(CHARACTERS - level)
            for t in range(TREES):
                prefix = asked[t] >> shift
                lows[level, t] = np.searchsorted(self.keys[t], prefix << shift)
                highs[level, t] = np.searchsorted(self.keys[t], (prefix + np.uint64(1)) << shift)
        runs = (highs - lows).sum(axis=1)
        for q in range(len(queries)):
            # The runs of all trees together must be long enough before they can be wide enough.
            level = int(np.flatnonzero(runs[:, q] >= wanted[q])[-1])
            while True:
                met = np.zeros(n, bool)
                for t in range(TREES):
                    met[self.order[t][lows[level, t, q] : highs[level, t, q]]] = True
                if level == 0 or met.sum() >= wanted[q]:
                    break
                level -= 1
            yield np.flatnonzero(met)


def nearest_of(met: np.ndarray, x: np.ndarray, ids: np.ndarray, query: np.ndarray, own, k: int, places=None):
    """The k nearest of the vectors met: their numbers and distances; ties to the smaller id, then place."""
    met = met[ids[met] != own]
    distance = np.sqrt(((x[met] - query) ** 2).sum(axis=1))
    best = np.lexsort((met if places is None else places[met], ids[met], distance))[:k]
    return met[best], distance[best]


def fitted_share(x: np.ndarray, target: float = TARGET) -> float:
    """Least share of a block that finds ``target`` of the true neighbours on a sample."""
    if len(x) <= 2 * NEAREST:
        return 1.0
    ids, centre = np.arange(len(x)), x.mean(axis=0)
    forest = Forest(x, centre)
    queries = x[:: max(1, len(x) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    own = ids[:: max(1, len(x) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    # Found means as near as the true one, so that equal vectors count alike.
    true = [nearest_of(ids, x, ids, q, i, NEAREST)[1] for q, i in zip(queries, own, strict=True)]
    for share in SHARES:
        found = total = 0
        for met, q, i, t in zip(forest.ascend(queries, share), queries, own, true, strict=True):
            got = nearest_of(met, x, ids, q, i, NEAREST)[1]
            found += int((got <= t[-1]).sum())
            total += len(t)
        if found >= target * total:
            return share
    return 1.0


def usable(vector: Column) -> Column:
    """Not null, not zero, and every component finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest_vectors(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEAREST,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows by Euclidean distance.

    Unusable vectors and rows without an id take no part; vectors of another
    length are never compared. A query isn't its own neighbour, nor is any row
    that repeats its id; another row that is repeated is a neighbour each time. Ties
    go to the smaller id. An id whose rows hold several vectors is one query, and the
    nearest of them counts.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        at(id_col).cast("long").alias("id"), at(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    # Equal rows of one id ask once; an id with several vectors asks with each of them.
    asking = stage(rows.where("asks").select("dim", "id", "v").distinct(), "asking")
    # One row per length: no more than the longest vector has entries.
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).join(
        asking.groupBy("dim").agg(F.count(F.lit(1)).alias("q")), "dim"
    ).select(
        "dim", F.expr(f"CAST((n + {BLOCK_ROWS - 1}) div {BLOCK_ROWS} AS INT)").alias("blocks"),
        F.expr(f"CAST((q + {CHUNK_QUERIES - 1}) div {CHUNK_QUERIES} AS INT)").alias("chunks"),
    )
    sizes = F.broadcast(stage(sizes, "sizes"))
    found = nearest_of_blocks(rows.join(sizes, "dim"), asking.join(sizes, "dim"), k)
    # Of several distances between an id and a row the smallest counts.
    single = found.groupBy("query_id", "row").agg(F.min("vec_id").alias("vec_id"), F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id", "row")
    ranked = single.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def fits(rows: DataFrame) -> dict[int, tuple[float, np.ndarray]]:
    """Share and centre by length, each fitted in a task on a sample by hash."""
    order = Window.partitionBy("dim").orderBy(F.xxhash64("id", F.lit(SEED)), "row")
    sample = rows.select("dim", "v", F.row_number().over(order).alias("place")).where(F.col("place") <= SAMPLE_ROWS)

    def fit(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = np.array(part.sort_values("place")["v"].tolist(), float)
        return pd.DataFrame({"dim": [key[0]], "share": [fitted_share(x)], "centre": [x.mean(axis=0)]})

    fitted = sample.groupBy("dim").applyInPandas(fit, "dim int, share double, centre array<double>").collect()
    return {r["dim"]: (r["share"], np.array(r["centre"], float)) for r in fitted}


def nearest_of_blocks(rows: DataFrame, asking: DataFrame, k: int) -> DataFrame:
    """Nearest of every block: vectors meet the queries of their length only."""
    fitted = rows.sparkSession.sparkContext.broadcast(fits(rows))

    def search(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []})
        share, centre = fitted.value[key[0]]
        x = np.array(rows["v"].tolist(), float)
        asks = np.array(queries["v"].tolist(), float)
        ids, own = rows["id"].to_numpy(np.int64), queries["id"].to_numpy(np.int64)
        places = rows["row"].to_numpy(np.int64)
        of_own = np.searchsorted(np.sort(ids), own, side="right") - np.searchsorted(np.sort(ids), own)
        out = []
        for met, query, i in zip(Forest(x, centre).ascend(asks, share, k, of_own), asks, own, strict=True):
            found, distance = nearest_of(met, x, ids, query, i, k, places)
            out.append(pd.DataFrame({"query_id": i, "row": places[found], "vec_id": ids[found], "score": distance}))
        return pd.concat(out)

    block = F.pmod(F.xxhash64("id", "row"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("id", "v"), F.col("chunks")).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = rows.select("dim", "id", "row", "v", block.alias("block"), every("chunks").alias("chunk"))
    right = asking.select("dim", "id", "v", every("blocks").alias("block"), chunk.alias("chunk"))
    key = ["dim", "block", "chunk"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        search, "query_id long, row long, vec_id long, score double"
    )


def searched(embeddings: DataFrame) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100."""
    return nearest_vectors(embeddings, F.pmod(F.col("vec_id"), F.lit(100)) == 0)
