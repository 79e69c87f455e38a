import hashlib
from collections import defaultdict

from pitpanel.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id long, text string, sha string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "x", None) for k, t in rows], SCHEMA).repartition(3)


def expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text or ""].append(key)
    out = []
    for text, keys in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        best = max(keys, key=lambda k: -1 if k is None else k)
        stays = False
        for key in keys:
            kept = key == best and not stays
            stays = stays or kept
            out.append((key, best, len(keys), kept, sha))
    return sorted(out, key=str)


def test_equals_a_plain_count(spark):
    rows = [(i, f"text {i % 7}") for i in range(40)] + [(100 + i, f"alone {i}") for i in range(10)]
    rows += [(200, None), (201, ""), (202, " "), (None, "text 1"), (300, "é" * 50_000), (301, "é" * 50_000)]
    rows += [(400, "again"), (400, "again"), (None, "none"), (None, "none")]
    got = sorted((tuple(r) for r in exact_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == expected(rows)
    # No digest may take the map-side way, or any.
    few = sorted((tuple(r) for r in exact_duplicates(frame(spark, rows), max_heavy=1).collect()), key=str)
    assert few == got


def test_stage_keeps_columns_and_one_row_a_text(spark):
    rows = [(i, f"text {i % 3}") for i in range(30)] + [(50, None), (51, ""), (60, "x"), (60, "x"), (None, "y"), (None, "y")]
    df = frame(spark, rows)
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null").collect()) == [
        (27, "text 0"), (28, "text 1"), (29, "text 2"), (51, ""), (60, "x")]
    assert kept.where("doc_id is null").count() == 1


def test_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_duplicates(df).count() == 0 and drop_exact_duplicates(df).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = exact_duplicates(frame(spark, [(1, "a"), (2, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
