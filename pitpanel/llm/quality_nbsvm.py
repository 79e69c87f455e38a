"""Text quality by naive Bayes support vectors.

A text becomes the set of its one- and two-token grams and of the three-token grams
of shapes (case, digits, marks, or the same token again), hashed. Every gram is
scaled by its class log-count ratio over all labelled documents; a linear hinge-loss
model on the scaled indicators, each text at unit length, is fitted by dual
coordinate descent on a bounded sample. Its margins become chances by a logistic curve fitted on
margins of texts that neither counts nor model of their half had seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, first_by_hash, fresh, ship

#: Labelled rows that the hinge-loss model is fitted on, and their grams in all, at most: documented bounds.
TRAIN_ROWS, TRAIN_GRAMS = 12_000, 8_000_000
#: Grams are hashed to so many bits: a fixed bound of every table of grams.
BITS = 19
#: Counts that travel to the driver together, by half and class.
PACKED, CELLS = 4096, ["c0", "c1", "c2", "c3"]
#: Added to each class count of a gram.
SMOOTH = 1.0
#: Cost of a violated margin, sweeps over the sample at most, and the gap that ends them.
COST, SWEEPS, GAP = 1.0, 30, 1e-2
#: Rows whose number has this remainder are held out.
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Letters of a text handled at once, and words remembered by a task.
PART, MEMO = 1 << 20, 1 << 17

#: A token: a run of letters and digits, or a run of other marks; case is kept.
TOKEN = re.compile(r"\w+|[^\w\s]+")
BLANK = re.compile(r"\s")


class Model(NamedTuple):
    weights: np.ndarray
    """Per hashed gram: hinge-loss weight times log-count ratio."""
    ratios: np.ndarray
    """Per hashed gram: the log-count ratio."""
    constant: float
    curve: tuple[float, float]
    """Chance = logistic(first + second * margin)."""


#: Shapes of a token by the first test it meets; then other marks, the same token again, and the text's start.
SHAPES = (str.islower, str.istitle, str.isupper, str.isdigit, str.isalnum)
MARKS, AGAIN, START = len(SHAPES), len(SHAPES) + 1, len(SHAPES) + 2


class Tokens(dict):
    """Hash of a token, the same in every process, with its shape in the lowest three bits.

    A bounded memory of them.
    """

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        shape = next((k for k, test in enumerate(SHAPES) if test(token)), MARKS)
        value = self[token] = xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) & ~7 | shape
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    """The upper bits of a multiplied and folded hash: gram numbers below 2 ** BITS."""
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return (values >> np.uint64(64 - BITS)).astype(np.int32)


def grams(text: str | None, memory: Tokens) -> np.ndarray:
    """Sorted distinct gram numbers of the whole text; none for a null or blank text."""
    if not text:
        return np.empty(0, np.int32)
    found, begin, before = [], 0, np.empty(0, np.uint64)
    lead = np.full(2, START, np.uint64)
    while begin < len(text):
        gap = BLANK.search(text, begin + PART)
        end = gap.start() if gap else len(text)
        words = np.array([memory[t] for t in TOKEN.findall(text, begin, end)], np.uint64)
        chain = np.concatenate([before, words])
        pairs = chain[:-1] * np.uint64(0xD6E8FEB86659FD93) + chain[1:]
        shapes = words & np.uint64(7)
        shapes[len(words) - len(pairs) :][chain[1:] == chain[:-1]] = AGAIN
        line = np.concatenate([lead, shapes])
        triples = np.unique((line[:-2] * np.uint64(8) + line[1:-1]) * np.uint64(8) + line[2:])
        found.append(np.unique(mixed(np.concatenate([words, pairs, triples + np.uint64(1)]))))
        before, lead, begin = chain[-1:], line[-2:], end
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))


def held_out(number: Column) -> Column:
    remainder = F.pmod(F.crc32(number.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text, good, half of every labelled document that isn't held out."""
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy(F.col("doc_id").alias("id")).agg((F.max("quality") > 0).cast("int").alias("good"))
    slim = docs.select(at(id_col).alias("id"), at(text_col).cast("string").alias("text"))
    # Equal texts are of one half, so that neither half knows the other's.
    half = F.pmod(F.xxhash64(F.coalesce("text", F.lit("")), F.lit("half")), F.lit(2)).cast("int")
    return slim.join(marked, "id").withColumn("half", half)


def class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents by (half, class) and gram, and by (half, class): whole counts, bounded tables."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, 1 << BITS), np.int32)
        sizes = np.zeros(4, np.int64)
        memory = Tokens()
        for batch in batches:
            for text, good, half in zip(batch["text"], batch["good"], batch["half"], strict=True):
                cell = 2 * half + good
                sums[cell][grams(text, memory)] += 1
                sizes[cell] += 1
        for cell in range(4):
            seen = np.flatnonzero(sums[cell])
            yield pd.DataFrame({
                "cell": cell, "gram": np.append(seen, -1), "n": np.append(sums[cell][seen].astype(np.int64), sizes[cell]),
            })

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros((4, PACKED), np.int64)
        table[:, part["gram"] % PACKED] = part[CELLS].to_numpy().T
        return pd.DataFrame({"block": [key[0]], "counts": [table.tobytes()]})

    counted = rows.select("text", "good", "half").mapInPandas(count, "cell int, gram long, n long")
    whole = counted.groupBy("gram").agg(*[F.sum(F.when(F.col("cell") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(CELLS)])
    # At most 2 ** BITS counts of four cells, in blocks; the block before the first holds the sizes.
    block = F.floor(F.col("gram") / PACKED).cast("int").alias("block")
    blocks = whole.groupBy(block).applyInPandas(pack, "block int, counts binary").collect()
    sums, sizes = np.zeros((4, 1 << BITS)), np.zeros(4)
    for row in blocks:
        table = np.frombuffer(row["counts"], np.int64).reshape(4, PACKED)
        if row["block"] < 0:
            sizes = table[:, -1].astype(float)
        else:
            sums[:, row["block"] * PACKED : (row["block"] + 1) * PACKED] = table
    return sums, sizes


def log_ratios(good: np.ndarray, bad: np.ndarray, goods: float, bads: float) -> np.ndarray:
    """ln of the share of good documents with a gram over that of bad ones, smoothed.

    A gram that no document has gets none.
    """
    p = (good + SMOOTH) / (goods + 2 * SMOOTH)
    q = (bad + SMOOTH) / (bads + 2 * SMOOTH)
    return np.where(good + bad > 0, np.log(p) - np.log(q), 0.0)


def unit_row(gram: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The row's values, of length one (all zero where no gram tells the classes apart)."""
    values = ratios[gram]
    size = np.sqrt(values @ values)
    return values / size if size > 0 else values


def hinge_loss(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and constant of least hinge loss, by dual coordinate descent.

    Violations of the rarer class weigh as much in all as those of the other one.
    """
    weights, constant = np.zeros(len(ratios)), 0.0
    signs = np.where(good > 0, 1.0, -1.0)
    share = np.maximum(1, np.bincount(good, minlength=2))
    upper = COST * np.sqrt(len(good) / (2.0 * share[good])) if len(good) else np.empty(0)
    values = [unit_row(g, ratios) for g in rows]
    square = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    draw = np.random.default_rng(seed)
    for _ in range(SWEEPS):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            gram, value, sign = rows[i], values[i], signs[i]
            slope = sign * (weights[gram] @ value + constant) - 1.0
            old = alpha[i]
            pull = min(slope, 0.0) if old <= 0 else max(slope, 0.0) if old >= upper[i] else slope
            worst = max(worst, abs(pull))
            if pull == 0.0:
                continue
            alpha[i] = min(max(old - slope / square[i], 0.0), upper[i])
            step = (alpha[i] - old) * sign
            weights[gram] += step * value
            constant += step
        if worst < GAP:
            break
    return weights, constant


def logistic_curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Place and slope of the chance of good by margin: Newton's method, slope at least zero."""
    rate = (good.sum() + 0.5) / (len(good) + 1.0)
    w = np.array([np.log(rate / (1 - rate)), 0.0])
    if min(good.sum(), len(good) - good.sum()) < 5:
        return float(w[0]), 0.0
    design = np.stack([np.ones(len(margin)), margin], axis=1)
    ridge = np.diag([1e-6, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curved = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curved, design.T @ (good - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(0.0, w[1]))


def sample(rows: DataFrame, limit: int) -> DataFrame:
    """good, half, gram numbers of at most ``limit`` distinct rows and ``TRAIN_GRAMS`` grams, by hash."""
    keyed = rows.select(
        "text", "good", "half", F.xxhash64("id", F.coalesce("text", F.lit("")), F.lit("train")).alias("order"),
    )
    places = stage(keyed.select("order").distinct(), "order")
    bound = first_by_hash(places, "order", limit, places.count()).agg(
        F.max(F.pmod("order", F.lit(1 << 40))).alias("last")
    ).first()["last"]

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = Tokens()
        for batch in batches:
            found = [grams(t, memory) for t in batch["text"]]
            yield batch[["good", "half", "order"]].assign(n=[len(g) for g in found], grams=found)

    chosen = keyed.where(F.pmod("order", F.lit(1 << 40)) <= F.lit(-1 if bound is None else bound)).dropDuplicates(["order"])
    chosen = stage(chosen.mapInPandas(numbers, "good int, half int, order long, n long, grams array<int>"), "sample")
    # Two numbers a row, for at most ``limit`` rows and those whose hash ties with the last.
    sizes = chosen.select("order", "n").toPandas().sort_values("order", kind="stable")
    over = sizes["order"][(sizes["n"].cumsum() > TRAIN_GRAMS) | (np.arange(len(sizes)) >= limit)]
    return chosen if over.empty else chosen.where(F.col("order") < int(over.iloc[0]))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS,
) -> Model:
    """The model, from labelled documents that aren't held out.

    Log-count ratios count every labelled document; the hinge loss is fitted on a
    sample by hash of at most ``rows``. Three fits run as tasks: each half scores the
    other's sample for the curve, and the third is the model. Labels are taken from
    ``labels`` (doc_id, quality); of several for one document, one that says good
    decides. Without labels of both classes the score is the share of good ones.
    """
    spark = docs.sparkSession
    ship(spark)
    known = stage(labelled(docs, labels, id_col, text_col), "labelled")
    sums, sizes = class_counts(known)
    halves = [slice(2, 4), slice(0, 2)]  # the cells of the other half
    ratios = [log_ratios(sums[s][1], sums[s][0], sizes[s][1], sizes[s][0]) for s in halves]
    both, counted = sums[:2] + sums[2:], sizes[:2] + sizes[2:]
    ratios.append(log_ratios(both[1], both[0], counted[1], counted[0]))
    shared = spark.sparkContext.broadcast(ratios)  # three arrays of 2 ** BITS numbers

    def solve(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """Fit ``key`` sees its own sample; fits 0 and 1 return the margins of that half."""
        part = part.sort_values(["order", "n"], kind="stable")
        mine, scale = key[0], shared.value[key[0]]
        learned = part[part["half"] != mine]
        gram = [np.asarray(g, np.int64) for g in learned["grams"]]
        weights, constant = hinge_loss(gram, learned["good"].to_numpy(np.int64), scale)
        if mine == 2:
            scaled = (weights * scale).astype(np.float32)
            return pd.DataFrame({"fit": 2, "good": -1, "value": [constant], "weights": [scaled.tobytes()]})
        apart = part[part["half"] == mine]
        margins = [weights[g] @ unit_row(g, scale) + constant for g in (np.asarray(g, np.int64) for g in apart["grams"])]
        return pd.DataFrame({"fit": mine, "good": apart["good"].to_numpy(), "value": margins, "weights": None})

    drawn = sample(known, rows).withColumn("fit", F.explode(F.array(*map(F.lit, (0, 1, 2)))))
    # As many rows as the sample has, and one of 2 ** BITS weights.
    solved = drawn.groupBy("fit").applyInPandas(solve, "fit int, good int, value double, weights binary").toPandas()
    weights, constant = np.zeros(1 << BITS, np.float32), 0.0
    last = solved[solved["fit"] == 2]
    if len(last):
        weights, constant = np.frombuffer(bytes(last["weights"].iloc[0]), np.float32), float(last["value"].iloc[0])
    apart = solved[solved["fit"] < 2]
    curve = logistic_curve(apart["value"].to_numpy(float), apart["good"].to_numpy(float))
    return Model(weights, ratios[2].astype(np.float32), constant, curve)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "quality_score") -> DataFrame:
    """Every row of ``docs`` with the chance that its whole text is good.

    A null, empty or blank text has no grams and scores as its margin, the constant,
    says. The new column gets another name where ``docs`` has one of that name.
    """
    spark: SparkSession = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # two arrays of 2 ** BITS numbers

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, memory = shared.value, Tokens()
        for texts in batches:
            margins = []
            for text in texts:
                found = grams(text, memory)
                ratio = model.ratios[found].astype(float)
                size = np.sqrt(ratio @ ratio)
                margins.append((float(model.weights[found].astype(float).sum()) / size if size > 0 else 0.0) + model.constant)
            place, slope = model.curve
            yield pd.Series(1 / (1 + np.exp(-np.clip(place + slope * np.array(margins, float), -30, 30))))

    return docs.withColumn(fresh(docs, name)[0], judge(at(text_col).cast("string")))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    slim = docs.select("doc_id", "text")
    return score(slim, fit(slim, labels), name="score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
