import random

import pytest
from pyspark.sql import functions as F

from pitpanel.llm.language_id import (
    address_parts, declared_in_markup, document_languages, host_of, keep_identified, page_languages,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, evidence string, host string"
WORDS = {
    "en": "the and of to in that which with from this have been were their would about there".split(),
    "de": "der die das und nicht mit ein eine für auf sich werden durch über können schön größe".split(),
    "fr": "le la les des est une dans pour avec être été où français même très après quelque".split(),
}


def docs(n=240, seed=2):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(list(WORDS))
        rows.append((i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.randint(5, 60))), lang, f"h{i % 5}", 0, "e", "h"))
    return rows


def test_languages_of_held_out_documents(spark):
    rows = docs()
    # A third of the rows declare nothing, so only their text speaks for them.
    hidden = {r[0]: r[2] for r in rows if r[0] % 3 == 0}
    df = spark.createDataFrame([(*r[:2], None if r[0] in hidden else r[2], *r[3:]) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in document_languages(df).collect()}
    assert len(got) == len(rows)
    assert sum(got[k].language == v for k, v in hidden.items()) >= 0.97 * len(hidden)
    assert all(r.kept for r in got.values() if r.probability >= 0.7)


def test_evidence_decides_where_the_text_does_not(spark):
    rows = docs() + [(900, "tag 12", "de", None, 0, "", ""), (901, "tag 12", "fr", None, 0, "", "")]
    got = {r.doc_id: r.language for r in document_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[900], got[901]) == ("de", "fr")


def test_rare_languages_of_a_large_table(spark):
    draw = random.Random(5)
    finnish = "ja on ei se että hän oli mutta kun niin myös kanssa ovat sitten kuin jossa yhteydessä".split()
    georgian = "და არის რომ ეს იყო მისი თუ როგორც მაგრამ უფრო".split()
    def say(words):
        return " ".join(draw.choice(words) for _ in range(40))
    many = spark.range(40_000).selectExpr(
        "id as doc_id", "'the and of to in that which with from this have been were their would about there' as text",
        "'en' as lang", "'h1' as source", "0L as n_chars", "'' as evidence", "'' as host")
    rows = [(50_000 + i, say(finnish), "fi" if i else None, "h2", 0, "", "") for i in range(31)]
    rows += [(60_000 + i, say(georgian), "ka" if i else None, "h3", 0, "", "") for i in range(6)]
    rows += [(70_000, say(WORDS["en"]), "xx", "h1", 0, "", "")]
    df = many.unionByName(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in document_languages(df).where("doc_id >= 50000").collect()}
    assert {k: (r.language, r.kept) for k, r in got.items()} == {
        **{r[0]: ("fi", True) for r in rows[:31]}, **{r[0]: ("ka", True) for r in rows[31:37]}, 70_000: ("en", True)}


def test_rejected_rows_go_and_columns_stay(spark):
    rows = docs() + [(901, None, "en", "h1", 0, "", ""), (902, "", None, None, 0, "", ""), (903, " \n", "en", "h1", 0, "", ""),
                     (904, "the and of to in " * 40_000, "en", "h1", 0, "", ""), (None, "the and of to in", "en", None, None, None, None),
                     (905, "the and", "en", "h1", 0, "", ""), (905, "the and", "en", "h1", 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = keep_identified(df)
    assert kept.columns == df.columns
    left = [r.doc_id for r in kept.collect()]
    assert not {901, 902, 903} & set(left) and {904, None} <= set(left) and left.count(905) == 2
    only = keep_identified(df, accept=("de",)).collect()
    assert only and {r.lang for r in only} == {"de"}


def test_tables_without_rows_or_labels(spark):
    assert document_languages(spark.createDataFrame([], SCHEMA)).count() == 0
    bare = spark.createDataFrame([(1, "some text", None, None, 0, "", "")], SCHEMA)
    assert [r.kept for r in document_languages(bare).collect()] == [False]


def test_pages_use_markup_and_address(spark):
    rows = [
        (r[0], f"http://{r[3]}.example.{r[2]}/x", f'<html lang="{r[2]}"><script>der die das</script><p>{r[1]}</p></html>') for r in docs()
    ] + [(900, None, None), (901, "http://h1.example.fr/", '<html lang="fr"><p>12</p>')]
    got = {r.page_id: r.language for r in page_languages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert sum(got[r[0]] == r[2] for r in docs()) >= 0.99 * 240 and got[901] == "fr" and got[900] is None


@pytest.mark.parametrize("url, host, domain, suffix", [
    ("https://A.b.example.ORG:80/x", "a.b.example.org", "example.org", "org"),
    ("http://u:p@host/", "host", "host", "host"), ("nothing", None, None, None), (None, None, None, None),
])
def test_addresses(spark, url, host, domain, suffix):
    h = host_of(F.col("u"))
    row = spark.createDataFrame([(url,)], "u string").select(h, *address_parts(h)).first()
    assert tuple(row) == (host, domain, suffix)


def test_markup_language(spark):
    pages = ['<!doctype html><HTML class=x lang=de-AT>', "<html lang='FR'>", "<html><p lang=es>", None]
    df = spark.createDataFrame([(p,) for p in pages], "h string").select(declared_in_markup(F.col("h")).alias("l"))
    assert [r.l for r in df.collect()] == ["de", "fr", None, None]
