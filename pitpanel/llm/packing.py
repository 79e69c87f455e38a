"""Best-fit packing of token pieces by non-negative least squares over patterns.

Only the histogram of piece lengths, at most ``capacity`` counts, reaches the
driver. Patterns of up to three lengths that fill a sequence exactly are
enumerated; a non-negative least-squares fit gives each a repeat count; counts
are rounded to what is really there, and the residual lengths are packed by
best fit, again on counts. Pieces are then numbered within their length, and a
piece's number names its place. No task or group holds all pieces of a length.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, chunks, fresh, ship

CAPACITY = 1024
END_ID = 2
#: The byte-level vocabulary as ranks: the same ids as its ``tokenizers`` file.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed values of that vocabulary.
END_OF_TEXT = "<|endoftext|>"
END_OF_TEXT_ID = 50256

#: A run of blanks, letters or other marks this long is left to the slower ``tokenizers``
#: library, which has no limit on it; the ids of both are the same.
LONG_RUN = 100_000
LONG = re.compile(rf"\s{{{LONG_RUN}}}|\w{{{LONG_RUN}}}|[^\s\w]{{{LONG_RUN}}}")

PIECES = "id {kind}, piece int, start long, length long, ids binary"
#: Pieces of one length that a task numbers at once, on average.
RANK_ROWS = 20_000


@lru_cache(maxsize=1)
def encoder(vocabulary: str):
    """The tokenizer of the vocabulary file, named or given by its path; one a worker."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={END_OF_TEXT: END_OF_TEXT_ID},
    )


@lru_cache(maxsize=1)
def patient_encoder(vocabulary: str):
    """The ``tokenizers`` form of the vocabulary beside ``vocabulary``."""
    import public_tokenizers
    from tokenizers import Tokenizer

    beside = re.sub(r"[.]tiktoken$", ".json", vocabulary)
    return Tokenizer.from_file(beside if "/" in beside else public_tokenizers.path(beside))


def token_ids(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a whole text."""
    if len(text) >= LONG_RUN and LONG.search(text):
        found = patient_encoder(vocabulary).encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, np.uint32)
    return encoder(vocabulary).encode_to_numpy(text, allowed_special="all")


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Token pieces of every text: id, piece, start, length, ids.

    ids: little-endian unsigned 32-bit. A document is its tokens and then
    ``end_id``; a null or empty text is ``end_id`` alone. Only documents over the
    capacity are cut, into full pieces behind a first one that may be shorter.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = 0
            for part in chunks(batch["text"]):
                ids, out = batch["id"].iloc[done : done + len(part)], []
                done += len(part)
                for key, text in zip(ids, part, strict=True):
                    tokens = np.append(token_ids(text.decode("utf-8", "replace"), vocabulary), end_id).astype("<u4")
                    edges = [0, *range(len(tokens) % capacity or capacity, len(tokens) + 1, capacity)]
                    if len(tokens) <= capacity:
                        edges = [0, len(tokens)]
                    out += [
                        (key, i, a, b - a, tokens[a:b].tobytes())
                        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
                    ]
                frame = pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids"])
                frame["id"] = frame["id"].astype(batch["id"].dtype)
                yield frame

    ship(docs.sparkSession)
    rows = docs.select(at(id_col).alias("id"), at(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # A missing id would turn whole numbers into floats in pandas.
    rows = rows.withColumn("id", F.col("id").cast("string"))
    return rows.mapInPandas(cut, PIECES.format(kind="string")).withColumn("id", F.col("id").cast(kind))


def patterns_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All multisets of up to three of ``lengths`` that sum to ``capacity``; 0 pads."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(np.flatnonzero(there), np.flatnonzero(there), indexing="ij")
    c = capacity - a - b
    good = (a <= b) & (b <= c)
    good[good] = there[c[good]]
    return np.stack([a[good], b[good], c[good]], axis=1)


def least_squares(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts >= 0 with patterns' usage near ``counts`` (accelerated projected gradient)."""
    size = len(counts)
    # Long lengths are harder to place later, so missing them weighs more.
    weight = 0.2 + np.arange(size) / size
    weight[0] = 0

    def usage(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(patterns[:, i], x, size) for i in range(3))

    # Largest eigenvalue of A' W A, by power iteration.
    probe, top = np.ones(len(patterns)), 1.0
    for _ in range(30):
        probe = (weight * usage(probe))[patterns].sum(1)
        top = float(np.linalg.norm(probe)) or 1.0
        probe /= top
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        slope = (weight * (usage(y) - counts))[patterns].sum(1)
        after = np.maximum(0, y - slope / (1.02 * top))
        t_after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def best_fit(counts: dict[int, int], capacity: int) -> dict[tuple[int, ...], int]:
    """Best-fit decreasing on counts of equal lengths: patterns with their repeats."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    spaces: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            i = bisect_left(spaces, length)
            if i == len(spaces):
                fit = capacity // length
                whole, rest = divmod(left, fit)
                for n, repeats in ((fit, whole), (rest, 1)):
                    if n and repeats:
                        space = capacity - n * length
                        if space not in open_bins:
                            insort(spaces, space)
                        bins = open_bins[space]
                        bins[(length,) * n] = bins.get((length,) * n, 0) + repeats
                break
            space = spaces[i]
            pattern, there = next(iter(open_bins[space].items()))
            used = min(there, left)
            left -= used
            if used == there:
                del open_bins[space][pattern]
                if not open_bins[space]:
                    del open_bins[space]
                    spaces.pop(i)
            else:
                open_bins[space][pattern] = there - used
            rest = space - length
            if rest not in open_bins:
                insort(spaces, rest)
            grown = (*pattern, length)
            open_bins[rest][grown] = open_bins[rest].get(grown, 0) + used
    out: dict[tuple[int, ...], int] = {}
    for bins in open_bins.values():
        for pattern, repeats in bins.items():
            out[pattern] = out.get(pattern, 0) + repeats
    return out


def pattern_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[tuple[int, ...], int]:
    """Patterns (lengths in order) and repeats that use every counted length exactly."""
    counts = np.zeros(capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    left = {k: int(v) for k, v in histogram.items() if v}
    plan: dict[tuple[int, ...], int] = {}
    patterns = patterns_of(np.array(sorted(left), int), capacity) if left else np.zeros((0, 3), int)
    patterns = patterns[(patterns[:, 1] > 0)] if len(patterns) else patterns
    if len(patterns):
        repeats = least_squares(patterns, counts)
        for i in np.argsort(-repeats, kind="stable"):
            n = int(round(repeats[i]))
            if n < 1:
                break
            pattern = tuple(int(x) for x in patterns[i][::-1] if x)
            n = min([n, *(left.get(x, 0) // pattern.count(x) for x in set(pattern))])
            if n > 0:
                plan[pattern] = n
                for x in pattern:
                    left[x] -= n
    for pattern, n in best_fit({k: v for k, v in left.items() if v}, capacity).items():
        plan[pattern] = plan.get(pattern, 0) + n
    return plan


def runs_of(plan: dict[tuple[int, ...], int]) -> np.ndarray:
    """Runs of places by length: length, first number, first sequence, offset; sorted."""
    runs, numbered, sequence = [], defaultdict(int), 0
    for pattern, repeats in plan.items():
        offset = 0
        for length in pattern:
            runs.append((length, numbered[length], sequence, offset))
            numbered[length] += repeats
            offset += length
        sequence += repeats
    return np.array(sorted(runs), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to every row of ``pieces``.

    Lengths are whole numbers from 1 to ``capacity``. A full piece is a sequence
    of its own and takes its row's number; no other piece shares it. Pieces of
    equal length may swap places, sequences have no gaps, and columns that
    clash with the two added ones are replaced. An empty table gives none.
    """
    spark = pieces.sparkSession
    ship(spark)
    row, chunk, number, before, spot = fresh(pieces, "row", "chunk", "number", "before", "spot")
    held = stage(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    counted = {r[0]: r[1] for r in held.groupBy(at(length_col).cast("long")).count().collect()}
    counted.pop(capacity, None)
    plan = pattern_plan(counted, capacity)
    table = runs_of(plan)
    sequences = sum(plan.values())
    alone = held.where(at(length_col) == capacity).withColumns(
        {"sequence_id": at(row) + F.lit(sequences), "offset": F.lit(0).cast("long")}
    )
    if not counted:
        return alone.drop(row)

    runs = spark.sparkContext.broadcast((table[:, 0] << 40 | table[:, 1], table))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, n: pd.Series) -> pd.DataFrame:
        keys, table = runs.value
        n = n.to_numpy(np.int64)
        run = table[np.searchsorted(keys, length.to_numpy(np.int64) << 40 | n, side="right") - 1]
        return pd.DataFrame({"sequence_id": run[:, 2] + n - run[:, 1], "offset": run[:, 3]})

    parts = -(-max(counted.values()) // RANK_ROWS)
    shared = held.where(at(length_col) != capacity).withColumn(chunk, F.pmod(F.xxhash64(at(row)), F.lit(parts)))
    key = [at(length_col), at(chunk)]
    numbered = shared.withColumn(number, F.row_number().over(Window.partitionBy(*key).orderBy(at(row))) - 1)
    if parts > 1:
        starts = shared.groupBy(*key).agg(F.count(F.lit(1)).alias(before)).withColumn(
            before, F.sum(at(before)).over(Window.partitionBy(at(length_col)).orderBy(at(chunk))) - at(before)
        )
        numbered = numbered.join(starts, [length_col, chunk]).withColumn(number, at(number) + at(before))
    placed = numbered.withColumn(spot, place(at(length_col), at(number).cast("long"))).withColumns(
        {"sequence_id": at(spot)["sequence_id"], "offset": at(spot)["offset"]}
    )
    names = list(dict.fromkeys([*pieces.columns, "sequence_id", "offset"]))
    return placed.select([at(c) for c in names]).unionByName(alone.select([at(c) for c in names]))


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Token ids are digested before anything is written, so only a few numbers per
    piece are shuffled; ``packed_sequences`` returns the ids themselves.
    """
    pieces = token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests, "length", capacity).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def packed_sequences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """The training sequences: sequence_id, ids (binary), documents (id, offset, length)."""
    packed = pack(token_pieces(docs, id_col, text_col, capacity, end_id, vocabulary), "length", capacity)
    # A sequence holds at most ``capacity`` tokens, so a group is small.
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(x["id"].alias(id_col), x["offset"], x["length"])).alias("documents"),
    )
