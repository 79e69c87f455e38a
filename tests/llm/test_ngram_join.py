import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitpanel.llm import ngram_join
from pitpanel.llm.ngram_join import WordHashes, components, drop_near_duplicates, parity_sketch, shingle_set, signatures, similar_groups

SCHEMA = "doc_id long, text string, row string, sig string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        same = len(sets[i] & sets[j])
        if same and 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    low = {}
    for i, (key, _) in enumerate(rows):
        low.setdefault(find(i), []).append(key)
    return [(rows[i][0], len(sets[i]), rows[i][0] if not sets[i] else min(low[find(i)])) for i in range(len(rows))]


def corpus(seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [draw.choice(vocabulary) for _ in range(60)]
    rows, key = [], 0
    for _ in range(60):
        size = draw.choice([3, 5, 6, 9, 15, 30, 66, 100, 140, 260, 520])
        base = [draw.choice(vocabulary) for _ in range(size)]
        if draw.random() < 0.5:
            base = base[: size // 3] + passage + base[size // 3 :]
        for _ in range(draw.randint(1, 5)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, max(1, size // 60), size // 40])):
                place = draw.randrange(len(words))
                kind = draw.random()
                words[place : place + (kind < 0.7)] = [draw.choice(vocabulary)] if kind < 0.9 else []
                words = words or ["w"]
            rows.append((key, " ".join(words)))
            key += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    # Few sets make a signature common here, so dropping common ones is tried as well.
    monkeypatch.setattr(ngram_join, "COMMON", 4)
    rows = corpus(seed)
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in rows], SCHEMA)
    got = sorted((r.id, r.n, r.low_id) for r in similar_groups(df).collect())
    assert got == sorted(brute_force(rows))


def test_a_large_group_of_near_copies_is_one_component(spark):
    draw = random.Random(3)
    base = [f"v{i}" for i in range(200)]
    rows = []
    for key in range(150):
        words = list(base)
        words[draw.randrange(200)] = f"new{key}"
        rows.append((key, " ".join(words)))
    df = spark.createDataFrame([(k, t, "", "") for k, t in rows], SCHEMA)
    assert {r.low_id for r in similar_groups(df).collect()} == {0}
    assert [r.doc_id for r in drop_near_duplicates(df).collect()] == [0]


def test_edge_rows(spark):
    long = " ".join(f"z{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "One two three four"), (5, "one TWO three\nfour"), (6, "one two three"),
        (7, long), (7, long), (8, long + " more"), (None, "one two three"),
    ]
    df = spark.createDataFrame([(k, t, "a", None) for k, t in rows], SCHEMA)
    got = sorted(((r.id, r.n, r.low_id) for r in similar_groups(df).collect()), key=str)
    assert got == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, 6),
        (7, 29_996, 7), (7, 29_996, 7), (8, 29_997, 7),
    ], key=str)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 4, 7, None]


def test_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert similar_groups(df).count() == 0
    assert drop_near_duplicates(df).count() == 0


def test_similar_sets_share_more_than_their_reserve():
    draw = np.random.default_rng(5)
    for n in (5, 8, 20, 50, 63, 64, 70, 100, 127, 130, 250, 300, 512, 520, 900, 2100):
        for _ in range(20):
            s = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
            gone = draw.integers(0, n // 9 + 1)
            # As many differences as similarity of 0.8 leaves: all gone, all new, or both.
            keep = s[gone:]
            new = draw.integers(0, 2**64, max(0, int(len(keep) / 0.8) - n), dtype=np.uint64)
            t = np.unique(np.r_[keep, new])
            same, whole = len(np.intersect1d(s, t)), len(np.union1d(s, t))
            assert 100 * same >= 80 * whole
            (a, spare_a, _, _), (b, spare_b, _, _) = signatures(s), signatures(t)
            if max(spare_a, spare_b) >= 0:
                assert len(np.intersect1d(a, b)) > max(0, min(spare_a, spare_b)) or min(spare_a, spare_b) < 0
                assert len(np.intersect1d(a, b)) >= 1


def test_sketches_never_differ_more_than_their_sets():
    draw = np.random.default_rng(6)
    for n in (1, 10, 200, 5000):
        s = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        t = np.unique(np.r_[s[n // 7 :], draw.integers(0, 2**64, n // 5, dtype=np.uint64)])
        bits = int(np.bitwise_count((parity_sketch(s) ^ parity_sketch(t)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(s, t))
        assert n != 200 or bits > 0.7 * len(np.setxor1d(s, t))


def test_shingles_follow_the_word_rule():
    hashes = WordHashes()
    assert len(shingle_set("A b c d e F".encode(), hashes)) == 2
    assert (shingle_set("a B\x0bc d e".encode(), hashes) == shingle_set("A b c\td e".encode(), hashes)).all()
    # Other white space belongs to words.
    assert len(shingle_set("a b c d e".encode(), hashes)) == 1
    assert len(shingle_set(b"a b c", hashes)) == 1 and len(shingle_set(b" ", hashes)) == 0


def test_components_of_a_long_chain(spark):
    edges = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {(r.node, r.root) for r in components(edges).collect()} == {(i, 0) for i in range(41)}
