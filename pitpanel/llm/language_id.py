"""Language identification by Bayesian evidence fusion.

Four pieces of evidence meet in log space: the text (byte-trigram likelihoods,
tempered, since neighbouring trigrams are not independent), the declared markup
language, the address suffix, and the host. How far a declaration or a suffix is
to be trusted is not assumed but counted: grouped aggregation over all rows, by
the text's own verdict, with Dirichlet smoothing. A host's prior is shrunk to its
registered domain's, that to its suffix's, that to the corpus's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import WORD, at, chunks, fresh, sheltered, ship

#: Trigrams are hashed into so many cells.
CELLS = 1 << 15
#: Labelled rows that the text model is fitted on, per language: a documented bound.
TRAIN_ROWS = 400
#: Labelled rows from which a language has a text model of its own in any table.
LEAST_ROWS = 20
#: Text models at most; further languages stand on declaration and host.
MAX_MODELS = 1000
#: A text counts as at most so many independent trigrams.
EFFECTIVE = 60
#: Pseudo-rows that shrink a host to its domain, a domain to its suffix, and so on.
SHRINK = 20.0
#: Rows whose best language is less probable than this are rejected.
LEAST = 0.7
#: The class of texts that fit no known language better than noise does.
UNKNOWN = "und"


def trigrams(text: bytes) -> np.ndarray:
    """Cells of the byte trigrams of the lower-cased text with a blank at both ends."""
    b = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    code = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    return (code * np.uint32(2654435761) >> np.uint32(17)).astype(np.int64)


def train(docs: DataFrame, text_col: str, label_col: str, id_col: str, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log-likelihoods (cells x languages, the last column is noise).

    Fitted on at most ``rows`` labelled rows per language, chosen by hash. The
    languages are those with ``LEAST_ROWS`` labelled rows, or with a thousandth of
    them all; the ``MAX_MODELS`` most frequent ones where there are more.
    """
    labelled = docs.where(at(label_col).isNotNull() & (F.length(at(text_col)) > 0)).select(
        at(label_col).cast("string").alias("label"), at(text_col).cast("string").alias("text"),
        F.xxhash64(at(id_col).cast("string"), F.lit("train")).alias("order"),
    )
    counts = stage(labelled.groupBy("label").count(), "labels")
    total = counts.agg(F.sum("count")).first()[0] or 0
    often = counts.where((F.col("count") >= LEAST_ROWS) | (F.col("count") * 1000 >= total))
    counted = often.orderBy(F.desc("count"), "label").limit(MAX_MODELS).collect()
    languages = sorted(r["label"] for r in counted)
    if not languages:
        return [], np.zeros((CELLS, 1))

    # A hash keeps about three times what is needed; of these the first rows are taken.
    share = docs.sparkSession.createDataFrame([(r["label"], min(1.0, 3.0 * rows / r["count"])) for r in counted], "label string, share double")
    near = labelled.join(F.broadcast(share), "label").where(F.pmod("order", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    first = F.row_number().over(Window.partitionBy("label").orderBy("order", "text"))
    picked = near.withColumn("first", first).where(F.col("first") <= rows).select("label", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"], strict=True):
                held = sums.setdefault(label, np.zeros(CELLS))
                held += np.bincount(trigrams(text.encode()), minlength=CELLS)
        for label, held in sums.items():
            yield pd.DataFrame({"label": [label], "cells": [held.astype("<f8").tobytes()]})

    sums = {x: np.full(CELLS, 0.5) for x in languages}
    for r in picked.coalesce(4).mapInPandas(count, "label string, cells binary").collect():
        sums[r.label] += np.frombuffer(r.cells, "<f8")
    table = np.stack([np.log(sums[x] / sums[x].sum()) for x in languages] + [np.full(CELLS, -np.log(CELLS))], axis=1)
    return languages, table


def text_evidence(table: np.ndarray):
    """A pandas UDF: tempered log-likelihood of a text under each column of ``table``."""
    small = table.astype(np.float32)

    @F.pandas_udf("array<double>")
    def evidence(texts: pd.Series) -> pd.Series:
        out = []
        for part in chunks(texts):
            for text in part:
                cells = trigrams(text) if text.strip() else np.zeros(0, np.int64)
                total = np.zeros(small.shape[1])
                for start in range(0, len(cells), 1 << 16):
                    total += small[cells[start : start + (1 << 16)]].sum(axis=0, dtype=np.float64)
                out.append(total * min(1.0, EFFECTIVE / max(1, len(cells))))
        return pd.Series(out)

    return evidence


def host_of(url: Column) -> Column:
    """The host in lower case, without port; null where there is no ``://``."""
    host = F.lower(F.regexp_extract(url, r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.when(F.length(host) > 0, host)


def address_parts(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix: the last two labels and the last one."""
    return F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def declared_in_markup(html: Column) -> Column:
    """Primary subtag of the ``lang`` attribute of the ``html`` element, or null."""
    tag = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)
    return F.when(F.length(tag) > 0, F.lower(tag))


def log_conditional(rows: DataFrame, key: str, classes: int, out: str, smooth: float = 1.0) -> DataFrame:
    """log P(key value | class) per value, counted from each row's text verdict."""
    sums = [F.sum((F.col("verdict") == i).cast("double")).alias(f"c{i}") for i in range(classes)]
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)
    counts = stage(counts, key)
    total = counts.agg(F.count(F.lit(1)).alias("values"), *[F.sum(f"c{i}").alias(f"t{i}") for i in range(classes)]).first()
    logs = [F.log((F.col(f"c{i}") + smooth) / F.lit((total[f"t{i}"] or 0.0) + smooth * max(1, total["values"]))) for i in range(classes)]
    return counts.select(F.col(key).alias(f"{key}_k"), F.array(*logs).alias(out))


def shrunk_priors(rows: DataFrame, classes: int) -> tuple[DataFrame, list[float]]:
    """P(class | host) per host, shrunk to domain, suffix and corpus (host_k, prior), and the corpus's."""
    each = [F.sum((F.col("verdict") == i).cast("double")).alias(f"n{i}") for i in range(classes)]
    hosts = rows.where("host is not null").groupBy("host", "domain", "suffix").agg(*each)

    def up(frame: DataFrame, keys: list[str]) -> DataFrame:
        return frame.groupBy(*keys).agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(classes)])

    def shrink(prior: str) -> Column:
        n = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(classes)])
        return F.array(*[(F.col(f"n{i}") + SHRINK * F.col(prior)[i]) / (n + SHRINK) for i in range(classes)])

    domains, suffixes = up(hosts, ["domain", "suffix"]), up(hosts, ["suffix"])
    whole = [n or 0.0 for n in rows.agg(*each).first()]
    flat = [(n + 1.0) / (sum(whole) + classes) for n in whole]
    suffixes = suffixes.withColumn("p0", F.array(*map(F.lit, flat))).select("suffix", shrink("p0").alias("p1"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", shrink("p1").alias("p2"))
    hosts = hosts.join(domains, ["domain", "suffix"]).select(F.col("host").alias("host_k"), shrink("p2").alias("prior"))
    return hosts, flat


def identify(
    rows: DataFrame, text_col: str, label_col: str, id_col: str,
    declared: Column | None = None, host: Column | None = None,
    accept: tuple[str, ...] | None = None, least: float = LEAST, train_rows: int = TRAIN_ROWS, whole: bool = True,
) -> DataFrame:
    """Every row (without its text unless ``whole``) with __language, __probability and __kept.

    The text model is fitted on rows with a label in ``label_col``; ``declared``
    is the language that the markup states, ``host`` the address. Missing
    evidence counts for nothing. A language without a text model has the noise's: it is
    the answer where a row labelled with it fits no fitted language better, or where
    an unlabelled row's host speaks for it. A row is kept when its best language is in
    ``accept`` (default: every labelled language) and has at least ``least``
    probability; so null, empty and blank texts are rejected, as are rows of a
    table without any label. An empty table gives an empty result.
    """
    ship(rows.sparkSession)
    languages, table = train(rows, text_col, label_col, id_col, train_rows)
    # The last two: languages without a text model, as one, and what is no language.
    classes = len(languages) + 2
    none = F.lit(None).cast("string")
    domain, suffix = address_parts(host if host is not None else none)
    label = at(label_col).cast("string")
    blank_text = ~F.coalesce(at(text_col).cast("string"), F.lit("")).rlike(WORD)
    cols = fresh(rows, "evidence", "declared", "host", "domain", "suffix", "blank", "rare", "labelled")
    full = rows.withColumns(dict(zip(cols, (
        text_evidence(table)(at(text_col).cast("string")),
        F.lower(declared) if declared is not None else none,
        host if host is not None else none, domain, suffix,
        blank_text, F.when(~label.isin(*languages, UNKNOWN) & label.rlike(WORD) & ~blank_text, label), label.isNotNull(),
    ), strict=True)))
    # Texts aren't written again: where they are wanted, they are scored once more.
    kept = rows.columns if whole else [c for c in rows.columns if c != text_col]
    written = stage(full.select([at(c) for c in ([] if whole else kept)] + [at(c) for c in cols]), "language")
    held = full if whole else written
    ev, dec, hos, dom, suf, blank, rare, labelled = (at(c) for c in cols)
    n = len(languages)
    best = F.array_position(ev, F.array_max(ev)) - 1
    best = F.when((best == n) & rare.isNull(), F.lit(n + 1)).otherwise(best)
    seen = written.where(~blank).select(
        best.alias("verdict"), dec.alias("declared"), hos.alias("host"), dom.alias("domain"), suf.alias("suffix"), rare.alias("rare")
    )
    # Small when there are few values; Spark broadcasts each only when its written size is small.
    by_declared = log_conditional(seen, "declared", classes, "ld")
    by_suffix = log_conditional(seen, "suffix", classes, "ls")
    by_host, corpus = shrunk_priors(seen, classes)
    by_host, flat = stage(by_host, "priors"), F.array(*map(F.lit, corpus))
    # A host's most frequent language without a text model.
    rare_at = seen.where(f"verdict = {n} and host is not null").groupBy("host", "rare").count()
    rare_at = stage(rare_at.groupBy("host").agg(F.max_by("rare", F.struct("count", "rare")).alias("host_rare")).select(
        F.col("host").alias("rare_k"), "host_rare"), "rare")
    zero = F.array(*[F.lit(0.0)] * classes)
    joined = (
        held.join(by_declared, dec == F.col("declared_k"), "left")
        .join(by_suffix, suf == F.col("suffix_k"), "left")
        .join(by_host, hos == F.col("host_k"), "left")
        .join(rare_at, hos == F.col("rare_k"), "left")
    )
    d, s, p = F.coalesce("ld", zero), F.coalesce("ls", zero), F.coalesce("prior", flat)
    noise, never = F.get(ev, F.lit(n)), F.lit(-1e9)
    other = F.coalesce(rare, F.when(~labelled, F.col("host_rare")))
    fits = [F.get(ev, F.lit(i)) for i in range(n)]
    fits += [F.when(other.isNotNull(), noise).otherwise(never), F.when(rare.isNull(), noise).otherwise(never)]
    logs = F.array(*[x + F.get(d, F.lit(i)) + F.get(s, F.lit(i)) + F.log(F.get(p, F.lit(i))) for i, x in enumerate(fits)])
    joined = joined.withColumn("__logs", logs).withColumn("__most", F.array_max("__logs"))
    total = F.aggregate(F.transform("__logs", lambda x: F.exp(x - F.col("__most"))), F.lit(0.0), lambda a, x: a + x)
    joined = joined.withColumn("__place", F.array_position("__logs", F.col("__most")).cast("int"))
    name = F.element_at(F.array(*[F.lit(x) for x in [*languages, UNKNOWN, UNKNOWN]]), F.col("__place"))
    joined = joined.withColumn("__language", F.when(~blank, F.when(F.col("__place") == n + 1, other).otherwise(name)))
    joined = joined.withColumn("__probability", F.when(~blank, F.lit(1.0) / total))
    wanted = F.col("__language").isin(*accept) if accept is not None else F.col("__place") <= n + 1
    return joined.select(
        *[at(c) for c in kept], "__language", "__probability",
        F.coalesce(wanted & (F.col("__probability") >= least), F.lit(False)).alias("__kept"),
    )


def document_languages(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, language, probability, kept; lang is the declaration, source the host."""
    slim = docs.select("doc_id", "text", "lang", "source")
    found = identify(slim, "text", "lang", "doc_id", F.col("lang"), F.col("source"), whole=False, **options)
    return found.select(
        "doc_id", F.col("__language").alias("language"), F.round("__probability", 6).alias("probability"), F.col("__kept").alias("kept")
    )


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose language is known and accepted, all columns, of any names."""
    def work(rows: DataFrame, id_col: str, text_col: str, lang: str, source: str) -> DataFrame:
        found = identify(rows, text_col, lang, id_col, at(lang), at(source), **options)
        return found.where("__kept").select([at(c) for c in rows.columns])

    return sheltered(docs, ["doc_id", "text", "lang", "source"], work)


def page_languages(pages: DataFrame, **options) -> DataFrame:
    """Per page: page_id, language, probability, kept, from html, its ``lang`` and the url."""
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ").alias("words"),
        declared_in_markup(F.col("html")).alias("declared"), host_of(F.col("url")).alias("host"),
    )
    found = identify(rows, "words", "declared", "page_id", F.col("declared"), F.col("host"), whole=False, **options)
    return found.select(
        "page_id", F.col("__language").alias("language"), F.round("__probability", 6).alias("probability"), F.col("__kept").alias("kept")
    )
