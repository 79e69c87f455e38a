import numpy as np
from pyspark.sql import functions as F

from pitpanel.llm import vector_search
from pitpanel.llm.vector_search import fitted_share, nearest_vectors, searched

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def frame(spark, ids, x):
    rows = [(None if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v], 0, "z") for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_force(ids, x, queries, k=10):
    out = {}
    x = np.asarray(x, np.float32).astype(float)
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_on_scattered_and_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 700)
    draw = np.random.default_rng(1)
    for x in (draw.standard_normal((2500, 32)), draw.standard_normal((50, 32))[draw.integers(0, 50, 2500)] + 0.1 * draw.standard_normal((2500, 32))):
        ids = np.arange(2500)
        want = brute_force(ids, x, ids[::100])
        got = searched(frame(spark, ids, x)).collect()
        assert len(got) == 250
        hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
        assert hits >= 0.9 * 250
        for r in got:
            assert {i: d for i, d in brute_force(ids, x, [r.query_id], 2500)[r.query_id]}[r.vec_id] == r.score
        by_query = {q: sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q) for q in want}
        assert all([r for r, _, _ in v] == list(range(1, 11)) and sorted(v, key=lambda t: t[1:]) == v for v in by_query.values())


def test_clustered_vectors_need_a_small_share():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((60, 32))[draw.integers(0, 60, 3000)] + 0.05 * draw.standard_normal((3000, 32))
    assert fitted_share(x) <= 0.1


def test_ties_go_to_the_smaller_id_and_few_rows_give_few(spark):
    same = [[1.0, 2.0]] * 30
    got = searched(frame(spark, range(30), same)).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, i, i, 0.0) for i in range(1, 11)]
    few = searched(frame(spark, [0, 3], [[1.0, 0.0], [0.0, 1.0]])).collect()
    assert [(r.rank, r.vec_id, r.score) for r in few] == [(1, 3, 2**0.5)]


def test_unusable_rows_take_no_part(spark):
    ids = [0, 1, 2, 3, 4, 5, 6, None, 100, 200]
    x = [[1, 1], [0, 0], None, [1, None], [float("nan"), 1], [float("inf"), 1], [2, 2], [1, 1], [0, 0], [1, 1, 1]]
    got = searched(frame(spark, ids, x)).collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 6)]
    assert searched(frame(spark, [], [])).count() == 0
    assert searched(frame(spark, [1], [[1, 2]])).count() == 0


def test_rows_that_repeat_an_id(spark):
    got = nearest_vectors(frame(spark, [0, 0, 1, 1], [[1, 0], [1, 0], [0, 1], [0, 1]]), F.col("vec_id") == 0).collect()
    assert {r.vec_id for r in got} == {1}


def brute_rows(rows, k=10):
    """(query_id, rank, vec_id, score) by brute force over rows, by the docstring's rules."""
    out = []
    for q in sorted({i for i, v in rows if i % 100 == 0}):
        mine = {tuple(v) for i, v in rows if i == q}
        near = []
        for place, (i, v) in enumerate(rows):
            ds = [sum((a - b) ** 2 for a, b in zip(m, v, strict=True)) ** 0.5 for m in mine if len(m) == len(v)]
            if i != q and ds:
                near.append((min(ds), i))
        out += [(q, r, i, d) for r, (d, i) in enumerate(sorted(near)[:k], 1)]
    return out


def test_repeated_queries_rows_and_many_lengths_equal_brute_force(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.integers(-3, 4, 4)]) for i in range(1, 9)]
    rows += [(0, [1.0, 2.0, 3.0, 4.0])] * 4 + [(100, [1.0, 0.0, 0.0, 0.0]), (100, [0.0, 9.0, 0.0, 0.0])] + rows[:2] * 2
    rows += [(1000 + 2 * d, [1.0] * d) for d in range(5, 45)] + [(100 * (50 + d), [1.5] * d) for d in range(5, 45)]
    rows = [(i, v) for i, v in rows if any(v)]
    got = searched(frame(spark, [i for i, _ in rows], [v for _, v in rows])).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got) == sorted((q, k, i, round(d, 9)) for q, k, i, d in brute_rows(rows))


def test_an_id_that_fills_a_block_still_finds_its_neighbours(spark):
    rows = [(0, [1.0, 1.0])] * 400 + [(i, [1.0 + i, 1.0]) for i in range(1, 30)]
    got = searched(frame(spark, [i for i, _ in rows], [v for _, v in rows])).collect()
    assert [(r.rank, r.vec_id) for r in got] == [(i, i) for i in range(1, 11)]
