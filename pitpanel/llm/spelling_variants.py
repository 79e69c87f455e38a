"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words come from whole texts and are counted over all documents. Two words are near
if one inserted, deleted or replaced code point makes them equal. An edit of a word
falls into one stretch of it, so both words agree before and behind that stretch:
the vocabulary is dealt to blocks by what lies outside of the stretch. Inside a
block, a bitset per (position, letter) tells which words have that letter there, and
one pass over a word's letters keeps, for all words of the block at once, the set
that matches without error and the sets that match with one error (replaced: same
positions; inserted: one ahead; deleted: one behind).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, ship

#: A word in the text: a longest run of these letters (fixed values of the contract).
LETTERS = "A-Za-zÀ-ÿ"
#: Least code points and occurrences of a word; a form is this many times as frequent.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One of so many (document, run) pairs loses a letter, where a table asks for it.
SLIP = 199
#: Words of a block at most; a larger one is dealt again by a shorter stretch.
BLOCK = 1 << 15
#: Distinct words, and letters of distinct words, that a task counts before it hands them on.
HELD_WORDS, HELD_LETTERS = 200_000, 4_000_000
#: Letters of a text handled at once.
PART = 1 << 20
#: Keys of large blocks that are broadcast, at most; more are joined.
BROADCAST_KEYS = 100_000

UPPER_TO_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
KEY = ["m", "lo", "hi", "head", "tail"]


def runs(text: str, least: int) -> Iterator[Counter]:
    """Counts of the runs of at least ``least`` letters, part by part; A-Z lower-cased."""
    wanted, other = re.compile(f"[{LETTERS}]{{{least},}}"), re.compile(f"[^{LETTERS}]")
    begin = 0
    while begin < len(text):
        gap = other.search(text, begin + PART)
        end = gap.start() if gap else len(text)
        out: Counter = Counter()
        for run, n in Counter(wanted.findall(text, begin, end)).items():
            out[run.lower() if run.isascii() else run.translate(UPPER_TO_LOWER)] += n
        yield out
        begin = end


def slipped(run: str, doc_id: object, every: int) -> str:
    """The run, without one letter if ``every`` divides the checksum of id and run."""
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    place = h % len(run)
    return run[:place] + run[place + 1 :]


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least: int = LEAST_LENGTH, slip: int | None = None,
) -> DataFrame:
    """word, n: the words of at least ``least`` letters of whole texts.

    A null text has no words; equal rows count each. With ``slip``, one of so many
    (document, run) pairs loses a letter first; a null id is an empty one there.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        letters = 0
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                for found in runs(text or "", least):
                    for run, n in found.items():
                        word = run if slip is None else slipped(run, doc_id, slip)
                        if len(word) >= least:
                            letters += 0 if word in held else len(word)
                            held[word] += n
                    if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                        yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                        held, letters = Counter(), 0
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    slim = docs.select(at(id_col).cast("string").alias("id"), at(text_col).cast("string").alias("text"))
    return slim.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Block:
    """Words that agree outside of one stretch: bitsets by (position, letter) of the stretch.

    ``m`` is the length of the longer words; the others lack one letter. Words stand
    in the order of falling count, then of code points, so the lowest bit of a set is
    its most frequent word.
    """

    def __init__(self, m: int, lo: int, hi: int, tail: str, words: list[tuple[str, int]]):
        self.words = sorted(words, key=lambda w: (-w[1], w[0]))
        self.m, self.lo, self.hi, self.next = m, lo, hi, tail[:1]
        self.index: list[dict[str, int]] = [{} for _ in range(hi - lo + 1)]
        self.long = 0
        cells: dict[tuple[int, str], list[int]] = {}
        for bit, (word, _) in enumerate(self.words):
            for place, letter in enumerate(self.stretch(word)):
                cells.setdefault((place, letter), []).append(bit)
        for (place, letter), bits in cells.items():
            self.index[place][letter] = bitset(bits)
        self.long = bitset([bit for bit, (word, _) in enumerate(self.words) if len(word) == m])
        self.all = (1 << len(self.words)) - 1
        self.short = self.all ^ self.long

    def stretch(self, word: str) -> str:
        return word[self.lo : self.hi - (self.m - len(word))]

    def near(self, word: str) -> int:
        """The bitset of the words that differ from ``word`` by one edit in the stretch.

        A letter inside a run of equal ones can be deleted at any of their places; such
        a pair counts only in the stretch of the run's last place.
        """
        letters, index = self.stretch(word), self.index
        none, exact, last = 0, self.all, self.all
        if len(word) == self.m:
            replaced = deleted = 0
            behind: dict[str, int] = {}
            for place, letter in enumerate(letters):
                here = index[place].get(letter, none)
                deleted = (deleted & behind.get(letter, none)) | exact
                last, exact = exact, exact & here
                replaced = (replaced & here) | (last ^ exact)
                behind = index[place]
            shorter = deleted & self.short
            if self.next and letters[-1] == self.next:
                shorter &= ~last
            return (replaced & self.long) | shorter
        inserted = 0
        for place, letter in enumerate(letters):
            inserted = (inserted | exact) & index[place + 1].get(letter, none)
            exact &= index[place].get(letter, none)
            if not (exact or inserted):
                return 0
        longer = (inserted | exact) & self.long
        if self.next:
            longer &= ~(exact & index[len(letters)].get(self.next, none))
        return longer

    def rows(self) -> Iterator[tuple[str, int, str, int]]:
        """word, number of near words, the most frequent of them and its count."""
        if not self.long:
            return
        for word, _ in self.words:
            found = self.near(word)
            if found:
                best, n = self.words[(found & -found).bit_length() - 1]
                yield word, found.bit_count(), best, n


def bitset(bits: list[int]) -> int:
    """A number with these bits set, ascending in ``bits``."""
    if not bits:
        return 0
    packed = bytearray((bits[-1] >> 3) + 1)
    for bit in bits:
        packed[bit >> 3] |= 1 << (bit & 7)
    return int.from_bytes(packed, "little")


def dealt(words: DataFrame) -> DataFrame:
    """A row per word and stretch: both halves, as the longer word and as the shorter one."""
    size = F.char_length("word")
    longer = words.withColumn("m", F.explode(F.array(size, size + 1)))
    half = F.expr("m div 2")
    stretches = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("m").alias("hi")))
    return longer.withColumn("at", F.explode(stretches)).select("word", "n", "m", "at.lo", "at.hi")


def halved(pieces: DataFrame) -> DataFrame:
    """The same rows with each stretch cut in two."""
    middle = F.expr("lo + (hi - lo) div 2")
    parts = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    return pieces.withColumn("at", F.explode(parts)).select("word", "n", "m", "at.lo", "at.hi")


def keyed(pieces: DataFrame) -> DataFrame:
    """With the letters outside of the stretch, counted from either end of the word."""
    size = F.char_length("word")
    return pieces.withColumns({
        "head": F.expr("substring(word, 1, lo)"),
        "tail": F.substring("word", size - F.col("m") + F.col("hi") + 1, F.col("m") - F.col("hi")),
    })


def blocks(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every word with its keys; no key has more than ``block`` words.

    A block that is larger is dealt again with each stretch halved. A stretch of one
    letter holds at most the alphabet and the word without it, so this ends.
    """
    level, done = keyed(dealt(words)), None
    while True:
        level = stage(level, "stretches")
        counts = level.where("hi - lo > 1").groupBy(*KEY).count().where(F.col("count") > block)
        large = stage(counts.drop("count"), "large-blocks")
        keys = large.count()
        if keys == 0:
            return level if done is None else done.unionByName(level)
        hint = F.broadcast(large) if keys <= BROADCAST_KEYS else large
        small = level.join(hint, KEY, "left_anti").select(*level.columns)
        done = small if done is None else done.unionByName(small)
        level = keyed(halved(level.join(hint, KEY, "left_semi").select("word", "n", "m", "lo", "hi")))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best, best_n of the words that have a near one; ``words``: word, n."""
    ship(words.sparkSession)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, out = None, [], []
        for batch in batches:
            for *here, word, n in batch[[*KEY, "word", "n"]].itertuples(index=False, name=None):
                if here != key:
                    if len(held) > 1:
                        out += Block(*key[:3], key[4], held).rows()
                    key, held = here, []
                held.append((word, n))
            if len(out) >= HELD_WORDS // 10:
                yield pd.DataFrame(out, columns=["word", "n_near", "best", "best_n"])
                out = []
        if len(held) > 1:
            out += Block(*key[:3], key[4], held).rows()
        if out:
            yield pd.DataFrame(out, columns=["word", "n_near", "best", "best_n"])

    parted = blocks(words, block).repartition(*KEY).sortWithinPartitions(*KEY)
    found = parted.select(*KEY, "word", "n").mapInPandas(search, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select(
        "word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")
    )


def followed(links: DataFrame) -> DataFrame:
    """word, root: each chain of (word, form) followed to its end.

    Every pass doubles the length followed. A form is several times as frequent as
    its word, so a chain is short and has no circle.
    """
    ends = stage(links.select("word", F.col("form").alias("root")), "chains")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if ends.join(onward, "root", "left_semi").isEmpty():
            return ends
        ends = stage(
            ends.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "chains"
        )


def spelling_groups(counts: DataFrame, least: int = LEAST_COUNT, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that occurs ``least`` times.

    ``counts`` holds distinct words of at least two letters and their counts n. A
    word's form is its near word of largest count (ties: first in code-point order),
    if that count is at least ``ratio`` times (two or more) the word's own, else null;
    its root is the end of the chain of forms, or the word itself. An empty table
    gives no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2, or chains of forms could run in circles")
    words = stage(counts.where(F.col("n") >= least).select("word", "n"), "words")
    near = near_words(words, block)
    has_form = F.col("best_n") >= ratio * F.col("n")
    table = stage(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    ), "forms")
    roots = followed(table.where("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def document_spellings(docs: DataFrame) -> DataFrame:
    """The spelling groups of the words of all texts, with the slips of the contract."""
    return spelling_groups(word_counts(docs, slip=SLIP))
