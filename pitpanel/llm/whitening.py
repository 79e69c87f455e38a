"""Whitening of vectors, exact where it counts.

Entries become integers, so counts, sums and the scatter of the centred vectors are
exact whatever the order of addition. The covariance is factored by Cholesky's method
with pivots; one-sided Jacobi rotations make the columns of the triangular factor
orthogonal. Their squared lengths are the eigenvalues, the columns at length one the
components. A last pass measures the covariance of the whitened values themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, ship

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Entries at least this large in absolute value have no exact product here; such a
#: vector counts as one that isn't finite.
LARGEST = float(1 << 48)
#: Bytes of the models, and of the squares that a task sums up, of one round of lengths.
MODEL_BYTES, SQUARE_BYTES = 64 << 20, 512 << 20
#: Numbers handled at once inside a task.
BLOCK = 1 << 20
#: Sweeps of rotations at most; they end when all columns are orthogonal to this.
SWEEPS, ORTHOGONAL = 60, 1e-15

TOTALS = "dim int, i int, j int, v string"


class Moments(NamedTuple):
    """Of the vectors of one length: their number and per-dimension sums."""

    n: int
    sums: list[int]

    def centre(self) -> np.ndarray:
        """The integers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)


class Model(NamedTuple):
    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    """Mean less ``centre``."""
    components: np.ndarray
    """A unit component per column, by falling eigenvalue."""
    values: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A row per vector, a column per component."""
        return ((x - self.centre).astype(float) - self.rest) @ self.components / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S)^2; null where it's more than a long holds."""
        off = np.array([self.n * int(c) - s for c, s in zip(self.centre, self.sums, strict=True)], object)
        near = x - self.centre
        most = self.n * int(np.abs(near).max(initial=0)) + max(map(abs, off), default=0)
        if most * most * max(1, x.shape[1]) < 1 << 62:
            apart = near * self.n + off.astype(np.int64)
            return (apart * apart).sum(axis=1).tolist()
        sums = [sum((self.n * int(v) + o) ** 2 for v, o in zip(row, off, strict=True)) for row in near]
        return [s if s < 1 << 63 else None for s in sums]


def usable(vector: str) -> str:
    """SQL: the vector is there and all of its entries are finite numbers."""
    finite = f"forall({vector}, c -> c IS NOT NULL AND NOT isnan(c) AND abs(CAST(c AS DOUBLE)) < {LARGEST!r}D)"
    return f"{vector} IS NOT NULL AND size({vector}) > 0 AND {finite}"


def by_length(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the batch and integer vectors, per length, in blocks."""
    sizes = vectors.map(len).to_numpy(int)
    for dim in np.unique(sizes):
        places = np.flatnonzero(sizes == dim)
        step = max(1, BLOCK // dim)
        for begin in range(0, len(places), step):
            part = places[begin : begin + step]
            c = np.stack([np.asarray(vectors.iloc[k], float) for k in part])
            yield part, np.floor(SCALE * c).astype(np.int64) + OFFSET


def totals(rows: DataFrame) -> DataFrame:
    """Exact sums by (dim, i, j) of the partial ones."""
    return rows.groupBy("dim", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))


def first_moments(vectors: DataFrame, dims: list[int]) -> dict[int, Moments]:
    """Number and sums of the vectors of each length: a pass that adds up integers."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for part, x in by_length(batch["vector"]):
                n, sums = held.get(x.shape[1], (0, 0))
                held[x.shape[1]] = n + len(part), sums + sum_of(x)
        for dim, (n, sums) in held.items():
            yield pd.DataFrame({"dim": dim, "i": np.arange(-1, dim), "j": 0, "v": [str(n), *map(str, sums)]})

    # A number per dimension of the lengths in ``dims``.
    table = totals(within(vectors, dims).mapInPandas(add, TOTALS)).collect()
    found: dict[int, dict[int, int]] = {}
    for row in table:
        found.setdefault(row["dim"], {})[row["i"]] = int(row["v"])
    return {d: Moments(v[-1], [v[i] for i in range(d)]) for d, v in found.items()}


def sum_of(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    return np.array([int(v) for v in (x >> 24).sum(axis=0)], object) * (1 << 24) + (x & ((1 << 24) - 1)).sum(axis=0).astype(object)


def scatter_of(near: np.ndarray) -> np.ndarray:
    """The exact product near.T @ near: by doubles where all sums stay below 2^53."""
    most = int(np.abs(near).max(initial=0))
    if most * most * len(near) < 1 << 53:
        wide = near.astype(float)
        return (wide.T @ wide).astype(np.int64)
    if most * most < 1 << 53:
        step = max(1, (1 << 53) // (most * most))
        parts = (near[k : k + step].astype(float) for k in range(0, len(near), step))
        return sum((w.T @ w).astype(np.int64).astype(object) for w in parts)
    wide = near.astype(object)
    return wide.T @ wide


def second_moments(vectors: DataFrame, moments: dict[int, Moments]) -> dict[int, np.ndarray]:
    """The exact scatter of the vectors less their rounded means, per length."""
    centres = vectors.sparkSession.sparkContext.broadcast({d: m.centre() for d, m in moments.items()})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch["vector"]):
                dim = x.shape[1]
                part = scatter_of(x - centres.value[dim])
                if part.dtype == object or np.abs(part).max() >= 1 << 53:
                    whole[dim] = whole.get(dim, 0) + part.astype(object)
                    continue
                sums = held.get(dim, np.zeros((dim, dim), np.int64)) + part
                if np.abs(sums).max() >= 1 << 61:
                    whole[dim], sums = whole.get(dim, 0) + sums.astype(object), np.zeros((dim, dim), np.int64)
                held[dim] = sums
        for dim, sums in [*held.items(), *whole.items()]:
            i, j = np.triu_indices(dim)
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "v": [str(v) for v in sums[i, j]]})

    # Half a square of numbers per length in ``moments``.
    table = totals(within(vectors, list(moments)).mapInPandas(add, TOTALS)).collect()
    out = {d: np.zeros((d, d), object) for d in moments}
    for row in table:
        out[row["dim"]][row["i"], row["j"]] = out[row["dim"]][row["j"], row["i"]] = int(row["v"])
    return out


def covariance(moments: Moments, scatter: np.ndarray) -> np.ndarray:
    """The centred covariance, each entry rounded once from the exact fraction.

    The scatter is about the rounded means; what they lack of the means is taken off.
    """
    n, off = moments.n, [s - moments.n * int(c) for s, c in zip(moments.sums, moments.centre(), strict=True)]
    d = len(off)
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = (n * int(scatter[i, j]) - off[i] * off[j]) / (n * n)
    return out


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """The factor L of a positive semidefinite matrix = L @ L.T, a column per pivot.

    Each pivot is the largest diagonal entry left; rows keep their places, so L is
    triangular up to the pivots' order. It ends when nothing but rounding is left.
    """
    d = len(matrix)
    left = np.diag(matrix).copy()
    least = left.max(initial=0.0) * d * np.finfo(float).eps
    factor = np.zeros((d, d))
    for k in range(d):
        p = int(np.argmax(left))
        if left[p] <= least:
            return factor[:, :k]
        column = (matrix[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(left[p])
        column[left == -np.inf] = 0.0  # earlier pivots
        factor[:, k] = column
        left = left - column * column
        left[p] = -np.inf
    return factor


def rotated(factor: np.ndarray) -> np.ndarray:
    """The factor with its columns rotated pair by pair until all are orthogonal.

    A round rotates disjoint pairs at once; all pairs meet once a sweep.
    """
    a = factor.copy()
    r = a.shape[1]
    ring = list(range(r)) + ([-1] if r % 2 else [])
    half = len(ring) // 2
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(x, y) for x, y in zip(ring[:half], ring[half:][::-1], strict=True) if x >= 0 and y >= 0]
            if pairs:
                p, q = np.array(pairs).T
                u, v = a[:, p], a[:, q]
                alpha, beta, gamma = (u * u).sum(0), (v * v).sum(0), (u * v).sum(0)
                cosine = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, np.finfo(float).tiny))
                worst = max(worst, float(cosine.max()))
                turn = cosine > ORTHOGONAL
                zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                t = np.where(turn, t, 0.0)
                c = 1 / np.sqrt(1 + t * t)
                a[:, p], a[:, q] = c * (u - t * v), c * (t * u + v)
            ring = [ring[0], ring[-1], *ring[1:-1]]
        if worst <= ORTHOGONAL * 8:
            break
    return a


def decompose(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a covariance matrix.

    The sign of a vector makes its entry of largest absolute value positive.
    """
    columns = rotated(pivoted_cholesky(matrix))
    lengths = np.sqrt((columns * columns).sum(0))
    order = np.argsort(-lengths, kind="stable")
    columns, lengths = columns[:, order], lengths[order]
    units = columns / lengths
    signs = np.sign(units[np.abs(units).argmax(0), np.arange(units.shape[1])]) if units.size else 1.0
    return lengths * lengths, units * signs


def model_of(moments: Moments, scatter: np.ndarray, components: int) -> Model:
    matrix = covariance(moments, scatter)
    values, units = decompose(matrix)
    values, units = values[:components], units[:, :components]
    centre = moments.centre()
    rest = np.array([(s - moments.n * int(c)) / moments.n for s, c in zip(moments.sums, centre, strict=True)])
    return Model(moments.n, moments.sums, centre, rest, units, values, values / max(np.trace(matrix), np.finfo(float).tiny))


def within(vectors: DataFrame, dims: list[int]) -> DataFrame:
    return vectors.where(F.size("vector").isin(dims))


def identity_errors(vectors: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest entry of the whitened values' covariance less the identity, per length."""
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, x in by_length(batch["vector"]):
                z = np.column_stack([np.ones(len(part)), shared.value[x.shape[1]].whitened(x)])
                held[x.shape[1]] = held.get(x.shape[1], 0.0) + z.T @ z
        for dim, square in held.items():
            i, j = np.triu_indices(len(square))
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "v": square[i, j]})

    sums = within(vectors, list(models)).mapInPandas(add, "dim int, i int, j int, v double")
    out = {}
    # Half a square of components per length.
    for dim, part in sums.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toPandas().groupby("dim"):
        n = models[dim].n
        k = models[dim].components.shape[1]
        square = np.zeros((k + 1, k + 1))
        square[part["i"], part["j"]] = square[part["j"], part["i"]] = part["v"]
        mean = square[0, 1:] / n
        out[int(dim)] = float(np.abs(square[1:, 1:] / n - np.outer(mean, mean) - np.eye(k)).max())
    return out


def rounds(dims: list[int]) -> Iterator[list[int]]:
    """The lengths in groups whose models and squares are of bounded size."""
    held, model, square = [], 0, 0
    for dim in sorted(dims):
        model, square = model + 8 * dim * (COMPONENTS + 4), square + 8 * dim * dim
        if held and (model > MODEL_BYTES or square > SQUARE_BYTES):
            yield held
            held, model, square = [], 8 * dim * (COMPONENTS + 4), 8 * dim * dim
        held.append(dim)
    if held:
        yield held


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Other columns don't come along, so their names can't clash.
    Vectors that are null or empty, or hold entries that are null, not finite or at
    least 2^48 in absolute value, are left out. All others fit the model and are
    whitened, equal rows each. Vectors of different lengths have no common space: each
    length is whitened by itself. Components whose eigenvalue is nothing but rounding
    don't exist, so a single vector, equal vectors or an empty table give no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    # Ids travel as text: integers with nulls among them would become doubles in pandas.
    slim = vectors.select(at(id_col).cast("string").alias("id"), at(vector_col).alias("vector")).where(usable("vector"))
    # One number per length: there are no more lengths than the longest vector has entries.
    dims = [r[0] for r in slim.groupBy(F.size("vector").alias("dim")).count().where("count > 1").select("dim").collect()]
    kind = "id string, component int, n long, deviation long, whitened double, explained double, identity_error double"
    id_type = vectors.select(at(id_col)).schema[0].dataType
    parts = []
    for group in rounds(dims):
        moments = first_moments(slim, group)
        scatters = second_moments(slim, moments)
        models = {d: model_of(m, scatters[d], components) for d, m in moments.items()}
        models = {d: m for d, m in models.items() if len(m.values)}
        if not models:
            continue
        errors = identity_errors(slim, models)
        shared = spark.sparkContext.broadcast((models, errors))

        def project(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            models, errors = shared.value
            for batch in batches:
                for part, x in by_length(batch["vector"]):
                    model = models[x.shape[1]]
                    k = len(model.values)
                    yield pd.DataFrame({
                        "id": batch["id"].iloc[part].repeat(k).array,
                        "component": np.tile(np.arange(1, k + 1), len(part)),
                        "n": model.n,
                        "deviation": pd.array(model.deviation(x), "Int64").repeat(k),
                        "whitened": model.whitened(x).ravel(),
                        "explained": np.tile(model.explained, len(part)),
                        "identity_error": errors[x.shape[1]],
                    })

        parts.append(within(slim, list(models)).mapInPandas(project, kind))
    if not parts:
        parts = [spark.createDataFrame([], kind)]
    if len(parts) > 1:
        parts = [stage(p, "whitened") for p in parts]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("id", F.col("id").cast(id_type))


def whitened_embeddings(embeddings: DataFrame) -> DataFrame:
    """The contract's columns for the table of embeddings."""
    return whiten(embeddings).withColumnRenamed("id", "vec_id")
