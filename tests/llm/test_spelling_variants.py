import random
import re
import zlib
from collections import Counter

import pytest

from pitpanel.llm import spelling_variants as sv

SCHEMA = "doc_id long, text string, id string, word string, N long, m int, lo int"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs, slip=None, least=6):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return dict(counts)


def brute_groups(counts, least=5, ratio=5):
    counts = {w: n for w, n in counts.items() if n >= least}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def dense_words(n, seed, alphabet="abà"):
    """Many words over few letters: every kind of near pair, runs of equal letters, ties."""
    draw = random.Random(seed)
    out = {}
    while len(out) < n:
        word = "".join(draw.choice(alphabet) for _ in range(draw.randint(6, 9)))
        out[word] = draw.choice([5, 5, 6, 24, 25, 26, 130, 131, 700])
    return out


@pytest.mark.parametrize(("n", "block"), [(700, sv.BLOCK), (700, 40), (350, 4)])
def test_groups_equal_brute_force_whatever_the_block(spark, n, block):
    counts = dense_words(n, seed=n + block)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [tuple(r) for r in sv.spelling_groups(frame, block=block).collect()]
    assert len(got) == len(set(got)) == n
    assert set(got) == brute_groups(counts)


def test_words_that_start_alike_are_dealt_again(spark):
    draw = random.Random(3)
    counts = {"internat" + "".join(draw.choice("abcdeé") for _ in range(draw.randint(3, 8))): draw.randint(5, 90) for _ in range(600)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    parted = sv.blocks(frame, block=32)
    assert parted.groupBy(*sv.KEY).count().where("hi - lo > 1").agg({"count": "max"}).first()[0] <= 32
    assert {tuple(r) for r in sv.spelling_groups(frame, block=32).collect()} == brute_groups(counts)


def test_chains_of_forms_end_at_their_root(spark):
    counts = {("aaaaaa" + "b" * k): 5 * 5**k for k in range(8)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in sv.spelling_groups(frame).collect()}
    assert set(got.values()) == {"aaaaaabbbbbbb"}


def test_whole_texts_are_counted(spark, monkeypatch):
    draw = random.Random(5)
    stems = ["Station", "Überall", "überalL", "ÑANDÚES", "stat1on", "naïveté", "short", "ÀÿÀÿÀÿ", "a×b÷cde"]
    docs = [(i % 50, " ".join(draw.choice(stems) + draw.choice(["", ",", "s", "\n"]) for _ in range(draw.randint(0, 60)))) for i in range(90)]
    docs += docs[:5] + [(None, "Station Station"), (7, None), (8, ""), (9, "x" * 2_300_000 + " Station"), (10, "Station," * 300_000)]
    want = brute_counts(docs, slip=7)
    frame = spark.createDataFrame([(i, t, "a", "b", 1, 2, 3) for i, t in docs], SCHEMA)
    for part, held in ((sv.PART, sv.HELD_WORDS), (64, 3)):
        monkeypatch.setattr(sv, "PART", part)
        monkeypatch.setattr(sv, "HELD_WORDS", held)
        got = sv.word_counts(frame.where("doc_id IS NULL OR doc_id < 9 OR doc_id > 10") if held == 3 else frame, slip=7)
        if held != 3:
            assert {r["word"]: r["n"] for r in got.collect()} == want
        else:
            small = [d for d in docs if d[0] is None or d[0] < 9 or d[0] > 10]
            assert {r["word"]: r["n"] for r in got.collect()} == brute_counts(small, slip=7)


def test_document_spellings_on_whole_documents(spark):
    draw = random.Random(8)
    words = list(dense_words(60, seed=2, alphabet="abcé"))
    docs = [(i, " ".join(draw.choice(words[: draw.choice([3, 20, 60])]) for _ in range(80))) for i in range(300)]
    frame = spark.createDataFrame([(i, t, "a", "b", 1, 2, 3) for i, t in docs], SCHEMA)
    got = sv.document_spellings(frame)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_groups(brute_counts(docs, slip=199))


def test_an_empty_table_gives_no_rows(spark):
    assert sv.document_spellings(spark.createDataFrame([], SCHEMA)).collect() == []
    assert sv.document_spellings(spark.createDataFrame([(1, None, "", "", 1, 1, 1)], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        sv.spelling_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
