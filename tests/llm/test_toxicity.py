import random
import time
import zlib

import numpy as np
import pytest

from pitpanel.llm.toxicity import fit, places_of, score, scored_documents, segments

SCHEMA = "doc_id long, text string, toxicity string, words string"
LABELS = "doc_id long, quality int, toxic int"
BAD = ["grobblat", "snurkish", "fleeb"]


def corpus(n=900, seed=6):
    draw = random.Random(seed)
    plain = [f"{a}{b}" for a in "ba ce di fo gu ha".split() for b in "lin mar nor pes".split()]
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randint(3, 80))]
        toxic = draw.random() < 0.15
        if toxic:
            for _ in range(draw.randint(1, 4)):
                words.insert(draw.randint(0, len(words)), draw.choice(BAD) + draw.choice(["", "", "ly", "ness"]))
        docs.append((i, " ".join(words), "x", "y"))
        if draw.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def brute_segments(scores):
    """All maximal scoring segments by the recursive definition: the best one, then left and right of it."""
    def rec(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[2] + 1e-12 or (abs(total - best[2]) <= 1e-12 and j - i < best[1] - 1 - best[0])):
                    best = (i, j + 1, total)
        return [] if best is None else rec(lo, best[0]) + [best] + rec(best[1], hi)

    return rec(0, len(scores))


def test_segments_equal_the_definition():
    draw = np.random.default_rng(9)
    for _ in range(300):
        scores = draw.integers(-5, 5, draw.integers(0, 14)) + draw.random() * 1e-3
        got, want = segments(scores), brute_segments(scores.tolist())
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for _, _, s in got], [s for _, _, s in want])


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in scored_documents(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(got) == len(docs)
    held = [(got[k].predicted, t) for k, _, t in labels if got[k].held_out]
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, *_ in docs)
    hit = sum(p == t for p, t in held)
    assert hit >= 0.97 * len(held) and sum(p and t for p, t in held) >= 0.9 * sum(t for _, t in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(400)
    turned = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, q, t in labels]
    df = spark.createDataFrame(docs, SCHEMA)
    one, two = (sorted((r.doc_id, r.score) for r in scored_documents(df, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, turned))
    assert one == two


def test_passages_and_edge_rows(spark):
    docs, labels = corpus()
    model = fit(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    long = "balin cemar " * 30_000 + "grobblat snurkish " + "dinor " * 30_000
    rows = [(1, None, "", ""), (2, "", "", ""), (3, long, "", ""), (None, "fleeb", None, None), (4, "12 ...", "", "")]
    got = {r.doc_id: r.toxicity for r in score(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got[1].score == got[2].score == got[4].score < 0.3 and got[1].words == 0 and got[1].passages == []
    span = max(got[3].passages, key=lambda p: p.sum)
    assert long[span.start : span.end] == "grobblat snurkish"
    assert got[None].score >= 0.3


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)], [(1, 1, None), (None, 1, 1)]])
def test_too_few_labels_give_one_score(spark, labels):
    docs = spark.createDataFrame([(1, "a b", "", ""), (2, "c", "", "")], SCHEMA)
    got = scored_documents(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 2 and len({r.score for r in got}) == 1


def test_an_empty_table(spark):
    assert scored_documents(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).count() == 0


def test_segments_take_linear_time():
    def seconds(n):
        scores = np.tile([1.8, -0.4, -0.4, -0.4, -0.4, -0.4], n)
        started = time.perf_counter()
        found = segments(scores)
        assert len(found) == n
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(100_000) < 5.0  # one that looks at all earlier candidates takes minutes


def test_spans_are_places_in_the_original_text():
    text = "İİ İstanbul fleeb x"
    spans = places_of(text, text.lower())
    assert "fleeb" in [text[a:b] for a, b in spans]
    assert places_of("Abc dé", "abc dé") == [(0, 3), (4, 6)]
