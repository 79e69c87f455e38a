from collections import defaultdict
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from pitpanel.functions.stages import stage
from tests.llm.test_mixing import plain_targets, size
from tests.llm.test_ngram_join import brute_force
from tools.check_queries import TABLES, table

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no driver tables")


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "exact dedup", "n-gram Jaccard join", "mixing to target weights", "best-fit packing"]


@needs_data
def test_every_stage_decides_as_a_plain_pass_over_its_input(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, function in corpus_pipeline.STAGES:
        seen.append(stage(function(spark, seen[-1], SMALL), name.replace(" ", "-")))
    assert all(df.columns == columns for df in seen[:-1])
    raw, named, single, apart, mixed, packed = [df.collect() for df in seen]

    # Language: these documents are all of one of four languages.
    assert {r.doc_id for r in named} == {r.doc_id for r in raw if (r.text or "").strip()}

    best = {}
    for r in named:
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in single) == sorted(best.values())

    groups = brute_force(sorted((r.doc_id, r.text) for r in single))
    assert sorted(r.doc_id for r in apart) == sorted({low for _, _, low in groups})

    sizes, taken, copies = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in apart:
        sizes[r.source] += size(r.text)
    for r in mixed:
        taken[r.source] += size(r.text)
        copies[r.doc_id] += 1
    order = sorted(sizes)
    want = plain_targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    longest = max(size(r.text) for r in apart)
    assert max(copies.values()) <= 3
    assert all(abs(taken[s] - t) <= max(0.15 * t, longest / 2) for s, t in zip(order, want))

    pieces = defaultdict(int)
    for r in packed:
        pieces[r.doc_id] += r.piece == 0
    assert dict(pieces) == dict(copies)
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= 1024


@needs_data
@pytest.mark.parametrize("name", ["op4_chat_format", "op6_exact_dedup"])
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = db.execute(entry_point.oracle_sql()[name])
    want = table([d[0] for d in result.description], result.fetchall())
    df = entry_point.queries()[name](spark, SMALL)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@needs_data
def test_the_join_equals_brute_force_on_the_given_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    got = entry_point.queries()["op1_ngram_join"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(brute_force(rows))
