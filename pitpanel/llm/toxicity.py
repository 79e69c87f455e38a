"""Toxic passages by maximum-scoring segments over token log-odds.

Tokens are words and the beginnings of words (compounds share them). Each has the
log-odds of toxic against clean labelled documents under an informative Dirichlet
prior; only significant ones are kept, and every other word costs a little. A
linear-time scan finds all maximal segments of positive sum. The best one of a
document is judged by extreme-value statistics: how likely a clean document of that
length has one as good, and so is the sum over its segments. Both, turned into odds
on labelled documents, are the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, chunks, first_by_hash, ship

#: Labelled rows that the model is fitted on, at most: a documented bound.
TRAIN_ROWS = 12_000
#: Tokens in the model, at most.
TOKENS = 20_000
#: Pseudo-documents of the Dirichlet prior, by the tokens' overall frequency.
PRIOR = 100.0
#: Least standard score, documents and log-odds of a kept token, most log-odds, and the cost of other words.
LEAST_Z, LEAST_DOCS, LEAST_ODDS, MOST_ODDS, COST = 2.3, 4, 1.8, 8.0, 0.4
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6, 7)
#: Rows whose number has this remainder are held out.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: A passage is reported when a clean text has one as good less often than this.
SIGNIFICANT = 0.05
MEMO = 1 << 18

WORDS = re.compile(r"[^\W\d_]+")


class Law(NamedTuple):
    """Gumbel law of a figure of clean texts: location + growth * ln(words), scale."""

    location: float = 0.0
    growth: float = 0.0
    scale: float = 1.0

    def surprise(self, figure: np.ndarray, words: np.ndarray) -> np.ndarray:
        """-ln of the chance that a clean text of that length has so high a figure."""
        z = (figure - self.location - self.growth * np.log1p(words)) / self.scale
        return -np.log(np.maximum(-np.expm1(-np.exp(np.clip(-z, -700, 30))), 1e-12))


class Model(NamedTuple):
    odds: dict[str, float]
    """Log-odds of kept tokens: a word as it is, a beginning with a ``*`` behind it."""
    best: Law
    """Law of the best segment's sum."""
    total: Law
    """Law of the sum over all segments."""
    weights: tuple[float, float, float]
    """Log-odds of toxic: a constant, and by the two surprises."""


def tokens_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


class WordScores(dict):
    """Score of a lower-cased word: its most telling kept token, else the cost."""

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        found = [self.odds[t] for t in tokens_of(word) if t in self.odds]
        value = self[word] = max(found, default=-COST)
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, sum), in order; linear time.

    Only positive entries start work; each new one joins the earlier candidates
    that it extends. A candidate knows the latest one before it that starts lower, so
    those between are skipped, and where none starts lower all of them are final.
    """
    done: list[tuple[int, int, float]] = []
    held: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum with, lower one
    sums = np.concatenate([[0.0], np.cumsum(scores)]).tolist()
    for i in np.flatnonzero(scores > 0).tolist():
        first, before, upto, j = i, sums[i], sums[i + 1], len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0:
                done += [(a, b, y - x) for a, b, x, y, _ in held]
                held = []
                break
            if held[j][3] >= upto:
                break
            first, before, lower = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = lower
        held.append((first, i + 1, before, upto, j))
    return done + [(a, b, y - x) for a, b, x, y, _ in held]


def places_of(text: str, lowered: str) -> list[tuple[int, int]]:
    """Spans of the words of ``lowered`` in ``text``; some letters get longer in lower case."""
    spans = [m.span() for m in WORDS.finditer(lowered)]
    if len(text) == len(lowered):
        return spans
    source = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(source[a], source[b - 1] + 1) for a, b in spans]


def figures(text: str, scores: WordScores) -> tuple[float, float, int, list[tuple[int, int, float]]]:
    """Best segment sum, sum over segments, words, and all segments (word numbers)."""
    words = WORDS.findall(text.lower())
    if not words:
        return 0.0, 0.0, 0, []
    values = np.fromiter(map(scores.__getitem__, words), float, len(words))
    found = segments(values)
    sums = [s for _, _, s in found]
    return max(sums, default=0.0), sum(sums), len(words), found


def score_of(best: np.ndarray, total: np.ndarray, words: np.ndarray, model: Model) -> np.ndarray:
    a, b, c = model.weights
    logit = a + b * model.best.surprise(best, words) + c * model.total.surprise(total, words)
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def significant(counts: pd.DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Log-odds of the tokens that tell toxic from clean; counts: token, y1, y0."""
    counts = counts[counts["y1"] >= LEAST_DOCS]
    y1, y0 = counts["y1"].to_numpy(float), counts["y0"].to_numpy(float)
    a = PRIOR * (y1 + y0) / max(1, toxic + clean)
    p1, p0 = (y1 + a) / (toxic + PRIOR), (y0 + a) / (clean + PRIOR)
    odds = np.log(p1) - np.log(p0)
    z = odds / np.sqrt(1 / (y1 + a) + 1 / (y0 + a))
    keep = (z >= LEAST_Z) & (odds > LEAST_ODDS)
    order = np.argsort(-z[keep], kind="stable")[:TOKENS]
    names, values = counts["token"].to_numpy()[keep][order], np.minimum(odds[keep][order], MOST_ODDS)
    return dict(zip(names, values.tolist(), strict=True))


def law_of(figure: np.ndarray, words: np.ndarray) -> Law:
    """Gumbel law by moments; its place may grow with the logarithm of the length."""
    lengths = np.log1p(words)
    x = lengths - lengths.mean()
    growth = max(0.0, float((x * figure).sum() / max(1e-9, (x * x).sum())))
    rest = figure - growth * lengths
    scale = max(0.5, float(rest.std()) * 6**0.5 / np.pi)
    return Law(float(rest.mean()) - 0.5772156649 * scale, growth, scale)


def calibrate(odds: dict[str, float], best: np.ndarray, total: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> Model:
    """Laws of clean documents, then the odds of the surprises by Newton's method."""
    clean = toxic == 0
    if clean.sum() < 10 or toxic.sum() < 5:
        rate = (toxic.sum() + 0.5) / (len(toxic) + 1)
        return Model(odds, Law(), Law(), (float(np.log(rate / (1 - rate))), 0.0, 0.0))
    laws = law_of(best[clean], words[clean]), law_of(total[clean], words[clean])
    design = np.stack([np.ones(len(best)), laws[0].surprise(best, words), laws[1].surprise(total, words)], axis=1)
    w, ridge = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (toxic - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return Model(odds, *laws, (float(w[0]), float(max(0.0, w[1])), float(max(0.0, w[2]))))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """text, toxic, half: at most ``rows`` labelled documents that aren't held out, chosen by hash."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    marked = stage(marked.withColumn("order", F.xxhash64("doc_id", F.lit("train"))), "marked")
    chosen = stage(first_by_hash(marked, "order", rows, marked.count()).drop("order"), "chosen")
    # At most ``rows`` pairs of numbers.
    chosen = F.broadcast(chosen.withColumnRenamed("doc_id", "__id"))
    slim = docs.select(at(id_col).alias("id"), F.coalesce(at(text_col).cast("string"), F.lit("")).alias("text"))
    return slim.join(chosen, F.col("id") == F.col("__id")).select(
        "text", "toxic", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int").alias("half")
    )


def held_out(number: Column) -> Column:
    return F.pmod(F.crc32(number.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """The model, from labelled documents that aren't held out.

    Tokens are counted by document. The law and the odds come from documents of
    one half scored by tokens of the other, so known words don't flatter them.
    """
    ship(docs.sparkSession)
    train = stage(training_rows(docs, labels, id_col, text_col, rows), "train")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[int, int], Counter] = {}
            for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"], strict=True):
                seen = {t for w in set(WORDS.findall(text.lower())) for t in tokens_of(w)}
                sums.setdefault((half, toxic), Counter()).update(seen)
            for (half, toxic), held in sums.items():
                yield pd.DataFrame({"token": list(held), "half": half, "toxic": toxic, "n": list(held.values())})

    counted = train.mapInPandas(count, "token string, half int, toxic int, n long")
    cell = [F.sum(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"y{t}_{h}") for h in (0, 1) for t in (0, 1)]
    # A kept token is in several toxic documents and mostly in those.
    counts = counted.groupBy("token").agg(*cell).where(f"y1_0 + y1_1 >= {LEAST_DOCS} and 3 * (y1_0 + y1_1) >= y0_0 + y0_1")
    counts = counts.orderBy(F.desc(F.expr("(y1_0 + y1_1) / (1.0 + y0_0 + y0_1)")), "token").limit(10 * TOKENS).toPandas()
    sizes = {(r.half, r.toxic): r["count"] for r in train.groupBy("half", "toxic").count().collect()}
    n = lambda t, *h: sum(sizes.get((x, t), 0) for x in h)

    def odds(*halves: int) -> dict[str, float]:
        sums = {f"y{t}": reduce(lambda a, b: a + b, [counts[f"y{t}_{h}"] for h in halves]) for t in (0, 1)}
        return significant(pd.DataFrame({"token": counts["token"], **sums}), n(1, *halves), n(0, *halves))

    apart = [odds(1), odds(0)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scores = [WordScores(x) for x in apart]
        for batch in batches:
            found = [figures(t, scores[h])[:3] for t, h in zip(batch["text"], batch["half"], strict=True)]
            yield pd.DataFrame(found, columns=["best", "total", "words"]).assign(toxic=batch["toxic"].to_numpy())

    # As many rows as were chosen.
    seen = train.mapInPandas(measure, "best double, total double, words long, toxic int").toPandas()
    return calibrate(odds(0, 1), *(seen[c].to_numpy(float) for c in ("best", "total", "words", "toxic")))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with toxicity: score, words and significant passages.

    A passage has its character span, its sum and its chance in a clean text. A
    null or empty text has no words; its score is that of a text without passages.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # at most TOKENS entries
    kind = "score double, words long, passages array<struct<start: int, end: int, sum: double, chance: double>>"

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scores = WordScores(model.odds)
        for texts in batches:
            best, total, words, passages = [], [], [], []
            for part in chunks(texts):
                for raw in part:
                    text = raw.decode("utf-8", "replace")
                    b, t, n, found = figures(text, scores)
                    best.append(b)
                    total.append(t)
                    words.append(n)
                    spans: list[dict] = []
                    if found:
                        chance = np.exp(-model.best.surprise(np.array([s for _, _, s in found]), np.full(len(found), n)))
                        good = [(a, e, s, float(c)) for (a, e, s), c in zip(found, chance, strict=True) if c < SIGNIFICANT]
                        if good:
                            places = places_of(text, text.lower())
                            spans = [{"start": places[a][0], "end": places[e - 1][1], "sum": s, "chance": c} for a, e, s, c in good]
                    passages.append(spans)
            yield pd.DataFrame({
                "score": score_of(np.array(best, float), np.array(total, float), np.array(words, float), model), "words": words, "passages": passages,
            })

    return docs.withColumn("toxicity", judge(at(text_col).cast("string")))


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    slim = docs.select("doc_id", "text")
    return score(slim, fit(slim, labels)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("toxicity.score").alias("score"), (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"),
    )
