import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitpanel.llm import exact_dedup, language_id, mixing, ngram_join, packing, quality_nbsvm, url_filter

#: Names that the operators use inside, in both letter cases.
INSIDE = (
    "target last __copies __size __u __blocks __starts __epoch __draw __shard __order blocks epochs more k u size pk "
    "prior ld ls lh ev evidence declared host domain suffix verdict rare labelled __language __probability __kept "
    "__best sha row best losers __id __key __stays __i id text_key root stays rows n "
    "__place number before chunk spot h_a h_c d_key s_key path rule input_0 input_1 word half good"
).split()


def documents(spark, extra):
    draw = random.Random(4)
    words = {"en": "the of and to in that is was for with".split(), "de": "der die und in den von zu das mit sich".split()}
    rows = []
    for i in range(80):
        lang = draw.choice(["en", "de"])
        text = " ".join(draw.choice(words[lang]) + draw.choice(["", "", "s", "en"]) for _ in range(30))
        rows.append((i, text, lang, f"src{i % 3}"))
    rows += [(100 + i, rows[i][1], rows[i][2], rows[i][3]) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in extra])


WORK = {
    "language": lambda d: language_id.keep_identified(d),
    "exact": lambda d: exact_dedup.drop_exact_duplicates(d),
    "near": lambda d: ngram_join.drop_near_duplicates(d),
    "mix with shards": lambda d: mixing.mix(d, shard_col="dealt"),
    "pack": lambda d: packing.pack(d.withColumn("length", F.least(F.col("n_chars"), F.lit(1024)))),
}


@pytest.mark.parametrize("work", WORK)
def test_extra_columns_of_any_name_come_through(spark, work):
    extra = [c.upper() if i % 2 else c for i, c in enumerate(INSIDE)]
    plain, clashing = WORK[work](documents(spark, [])), WORK[work](documents(spark, extra))
    assert [c for c in clashing.columns if c not in extra] == plain.columns
    key = ["doc_id", "text", "lang", "source"]
    want = sorted(map(tuple, plain.select(key).collect()))
    rows = clashing.collect()
    assert sorted(tuple(r[c] for c in key) for r in rows) == want
    assert all(r[c] == f"own {c}" for r in rows for c in extra if not (work == "pack" and c in ("sequence_id", "offset")))


def test_pages_with_any_columns_are_judged(spark):
    extra = ["h_a", "h_key", "d_a", "S_KEY", "judged_host", "input_0"]
    pages = spark.createDataFrame([(1, "http://a.example.org/x"), (2, None)], "page_id long, url string").select("*", *[F.lit(c).alias(c) for c in extra])
    outcomes = spark.createDataFrame([("a.example.org", True)] * 20, "host string, bad boolean")
    rows = url_filter.judge(pages, outcomes).collect()
    assert sorted((r["page_id"], r["host"]) for r in rows) == [(1, "a.example.org"), (2, "")]
    assert all(r[c] == c for r in rows for c in extra)


def test_quality_scores_keep_all_columns(spark):
    docs = documents(spark, ["quality_score", "good", "half", "order"])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    scored = quality_nbsvm.score(docs, quality_nbsvm.fit(docs, labels))
    assert scored.columns == [*docs.columns, "_quality_score"] and scored.count() == docs.count()


def test_the_stages_take_extra_columns(spark, tmp_path):
    docs = documents(spark, ["target", "prior", "__best", "__id", "__place", "LD"])
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs.write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = function(spark, spark.read.parquet(str(tmp_path / name.replace(" ", "-"))), "")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0 and docs.where("LD != 'own LD'").count() == 0
