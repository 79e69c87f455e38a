import random
import re
from collections import defaultdict

import numpy as np
import pytest

from pitpanel.llm.mixing import mix, mix_report, split_quotas, targets_of

SCHEMA = "doc_id long, text string, source string, k string, size string"


def docs():
    draw = random.Random(8)
    rows = []
    for i in range(900):
        source = draw.choice(["a", "a", "a", "b", "c", "D", None, "é"])
        rows.append((i, " ".join("w" for _ in range(draw.choice([1, 3, 10, 40, 200]))), source))
    return rows + [(1000, None, "a"), (1001, "", "b"), (1002, " ", "z"), (1003, "one two\x0bthree", "b")]


def frame(spark, rows):
    return spark.createDataFrame([(k, t, s, "x", "y") for k, t, s in rows], SCHEMA).repartition(3)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights):
    capped = set()
    while True:
        rest = sum(sizes) - sum(3 * sizes[i] for i in capped)
        share = sum(w for i, w in enumerate(weights) if i not in capped)
        out = [3.0 * s if i in capped else rest * weights[i] / share for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in capped and out[i] > 3 * s}
        if not over:
            return out
        capped |= over


def test_report_meets_the_targets(spark):
    rows = docs()
    got = mix_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    source = {k: s for k, _, s in rows}
    sizes = defaultdict(int)
    for k, t, s in rows:
        sizes[s] += size(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, plain_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])))
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - want[s]) <= max(3, 0.01 * want[s])
    again = mix_report(frame(spark, rows[::-1])).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_rows_of_the_mixture_are_its_draws(spark):
    rows = docs()
    df = frame(spark, rows)
    report = {r.doc_id: r.taken // r.size for r in mix_report(df).collect() if r.size}
    drawn = mix(df, shard_col="shard")
    assert drawn.columns == [*df.columns, "shard"]
    found = defaultdict(int)
    shards = defaultdict(int)
    for r in drawn.collect():
        found[r.doc_id] += 1
        shards[r.shard] += 1
    assert {k: found.get(k, 0) for k in report} == report
    assert set(shards) <= set(range(16)) and len(shards) > 8
    assert mix(df).columns == df.columns


def test_caps_are_shared_again():
    assert targets_of([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    assert targets_of([10, 100, 100], [5, 2, 1]) == pytest.approx([30, 120, 60])
    assert targets_of([0, 0], [5, 2]) == [0, 0] and targets_of([], []) == []


def test_quotas_of_shards_add_up():
    quotas = [1000, 3, 0, 77]
    got = split_quotas(quotas, 13)
    assert got.shape == (13, 4) and (got >= 0).all() and got.sum(axis=0).tolist() == quotas
    sizes = got.sum(axis=1)
    assert sizes.max() - sizes.min() <= 4
    assert (split_quotas(quotas, 13) == got).all()
    assert np.abs(got[:, 0] - 1000 / 13).max() < 20


def test_edge_tables(spark):
    assert mix_report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    same = mix_report(frame(spark, [(1, "a b", "s")] * 4 + [(None, None, None)])).collect()
    assert sum(r.taken for r in same) == 8 and all(r.taken <= 6 for r in same)
