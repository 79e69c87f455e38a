import random
import zlib

import numpy as np

from pitpanel.llm import quality_nbsvm as qn

SCHEMA = "doc_id long, text string, quality_score string, score string, good int, half int, ORDER int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=700, seed=4):
    draw = random.Random(seed)
    plain = [a + b for a in "ba ce di fo gu ha lo mi".split() for b in "lin mar nor pes tus".split()]
    docs, labels = [], []
    for i in range(n):
        words = [draw.choice(plain) for _ in range(draw.randint(4, 90))]
        good = draw.random() < 0.8
        if not good:
            kind = draw.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + " ###" for w in words] if kind == 1 else [w for w in words[:12] for _ in range(6)]
        docs.append((i, " ".join(words)))
        if draw.random() < 0.7:
            labels.append((i, int(good), 0))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, "a", "b", 1, 2, 3) for i, t in docs], SCHEMA),
        spark.createDataFrame(labels, LABELS),
    )


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    rows = qn.scored_documents(*frames(spark, docs, labels)).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    label = {i: q for i, q, _ in labels}
    test = [(label[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(test) > 60 and sum(a == b for a, b in test) / len(test) > 0.97


def test_labels_of_held_out_rows_are_not_seen(spark):
    docs, labels = corpus(300)
    docs_frame, one = frames(spark, docs, labels)
    _, other = frames(spark, docs, [(i, 1 - q if held(i) else q, t) for i, q, t in labels])
    key = lambda r: r["doc_id"]
    assert sorted(qn.scored_documents(docs_frame, one).collect(), key=key) == sorted(qn.scored_documents(docs_frame, other).collect(), key=key)


def test_counts_are_whole_and_ratios_by_hand(spark):
    docs, labels = corpus(120)
    docs_frame, label_frame = frames(spark, docs + docs[:10], labels)
    known = qn.labelled(docs_frame, label_frame, "doc_id", "text")
    sums, sizes = qn.class_counts(known)
    memory, label = qn.Tokens(), {i: q for i, q, _ in labels}
    want, count = np.zeros((2, 1 << qn.BITS)), [0, 0]
    for i, text in docs + docs[:10]:
        if i in label and not held(i):
            want[label[i]][qn.grams(text, memory)] += 1
            count[label[i]] += 1
    assert (sums[:2] + sums[2:] == want).all() and (sizes[:2] + sizes[2:]).tolist() == count
    ratios = qn.log_ratios(want[1], want[0], count[1], count[0])
    gram = int(qn.grams("balin", memory)[0])
    p = (want[1][gram] + 1) / (count[1] + 2)
    q = (want[0][gram] + 1) / (count[0] + 2)
    assert abs(ratios[gram] - np.log(p / q)) < 1e-12


def test_the_descent_reaches_the_least_hinge_loss():
    draw = np.random.default_rng(0)
    rows = [np.unique(draw.integers(0, 12, 5)) for _ in range(60)]
    good = np.array([int(3 in r or 7 in r) for r in rows])
    ratios = draw.normal(size=12) + 0.2
    weights, constant = qn.hinge_loss(rows, good, ratios)
    x = np.zeros((60, 12))
    for k, r in enumerate(rows):
        x[k, r] = qn.unit_row(r, ratios)
    share = np.bincount(good, minlength=2)
    cost = np.sqrt(60 / (2.0 * share[good]))
    sign = 2 * good - 1

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - sign * (x @ w + b))).sum()

    best = loss(weights, constant)
    for _ in range(300):
        assert loss(weights + draw.normal(size=12) * 0.03, constant + draw.normal() * 0.03) >= best * (1 - 2e-3)


def test_grams_of_whole_texts_do_not_depend_on_parts(monkeypatch):
    memory = qn.Tokens()
    text = "eee eee eee a bb ccc, ddd! EEE ü 12 " * 300
    whole = qn.grams(text, memory)
    monkeypatch.setattr(qn, "PART", 50)
    assert (qn.grams(text, memory) == whole).all()
    assert len(qn.grams("y" * 3_000_000, memory)) == 2
    assert qn.grams(None, memory).size == qn.grams("", memory).size == qn.grams(" \n\t", memory).size == 0
    assert set(qn.grams("eee eee eee", memory)) <= set(whole)


def test_nulls_ties_repeats_clashes_and_empty_tables(spark):
    docs, labels = corpus(200)
    odd = [(None, "balin balin"), (900, None), (901, ""), (902, "x " * 400_000), (0, docs[0][1]), (0, docs[0][1])]
    docs_frame, label_frame = frames(spark, docs + odd, labels + [(None, 1, 0), (3, None, None), (900, 1, 0), (1, 0, 0), (1, 1, 0)])
    rows = qn.scored_documents(docs_frame, label_frame).collect()
    assert len(rows) == 206 and all(r["score"] is not None for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[900]["score"] == by_id[901]["score"] and by_id[None]["held_out"] is False
    scored = qn.score(docs_frame, qn.fit(docs_frame, label_frame))
    assert scored.columns == [*docs_frame.columns, "_quality_score"]
    empty, none = frames(spark, [], [])
    assert qn.scored_documents(empty, none).collect() == []
    assert {r["score"] for r in qn.scored_documents(docs_frame, none).collect()} == {0.5}


def test_the_sample_is_bounded_and_the_counts_are_not(spark, monkeypatch):
    docs, labels = corpus(300)
    known = qn.labelled(*frames(spark, docs + [docs[2]] * 400, labels), "doc_id", "text")
    assert qn.sample(known, 50).count() == 50
    monkeypatch.setattr(qn, "TRAIN_GRAMS", 900)
    assert 0 < qn.sample(known, 50).agg({"n": "sum"}).first()[0] <= 900
