import random

import pytest
from pyspark.sql import functions as F

from pitpanel.llm.url_filter import host_and_path, judge, judged_pages, page_outcomes

SCHEMA = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("https://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12?x=/es/", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2#a", "example.org", "/en/2", "org/", "allow"),
    ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
    ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    ("http://x.com/DE/1", "x.com", "/DE/1", None, "allow"),
    ("http://xcom/de/1", "xcom", "/de/1", None, "allow"),
    ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    ("http://org", "org", "", None, "allow"), ("http://org/", "org", "/", "org/", "allow"),
    ("a://b?c://d.org/", "b", "", None, "allow"), ("x://É.Org/A%20b#", "É.org", "/A%20b", "org/", "allow"),
    ("no scheme.org/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://" + "a" * 50_000 + ".org/" + "b" * 50_000, "a" * 50_000 + ".org", "/" + "b" * 50_000, "org/", "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "")], SCHEMA)
    row = judged_pages(pages, spark.createDataFrame([], LABELS)).first()
    assert tuple(row) == (1, host, path, rule, verdict)


def outcomes(draw):
    rows = []
    for i in range(60):
        rate = 0.8 if i < 6 else 0.1
        domain = "bad.net" if i < 6 else f"d{i % 9}.net"
        rows += [(f"h{i}.{domain}", draw.random() < rate) for _ in range(draw.choice([1, 4, 60]))]
    return rows


def plain_posteriors(rows):
    """The same estimate with dictionaries."""
    def rho(groups):
        spread = sum(n * (b / n - m) ** 2 / (m * (1 - m)) for n, b, m in groups)
        count, total = len(groups), sum(n for n, _, _ in groups)
        r = (spread - count) / (total - count) if total > count else 0.5
        r = min(max(r, 1e-4), 0.5)
        return (1 - r) / r

    def counts(key):
        out = {}
        for h, bad in rows:
            n, b = out.get(key(h), (0, 0))
            out[key(h)] = (n + 1, b + bad)
        return out

    suffix, domain = lambda h: h.split(".")[-1], lambda h: ".".join(h.split(".")[-2:])
    mean = {None: (sum(b for _, b in rows) + 1) / (len(rows) + 2)}
    above = lambda k: None
    for key, up in ((suffix, lambda k: None), (domain, suffix), (lambda h: h, domain)):
        groups = {k: (n, b, mean[up(k)]) for k, (n, b) in counts(key).items()}
        s = rho(list(groups.values()))
        post = {k: (b + s * m, n - b + s * (1 - m)) for k, (n, b, m) in groups.items()}
        mean = {**mean, **{k: a / (a + c) for k, (a, c) in post.items()}}
    del above
    return post


def test_reputations_equal_a_plain_estimate(spark):
    rows = outcomes(random.Random(3))
    pages = spark.createDataFrame([(i, f"http://{h}/", "") for i, h in enumerate(sorted({h for h, _ in rows}))], SCHEMA)
    post = plain_posteriors(rows)
    got = judge(pages, spark.createDataFrame(rows, "host string, bad boolean")).collect()
    for r in got:
        a, c = post[r.host]
        rate = a / (a + c)
        assert r.bad_rate == pytest.approx(rate)
        bound = rate - 1.645 * (rate * (1 - rate) / (a + c + 1)) ** 0.5
        assert r.bound == pytest.approx(bound) and r.verdict == ("block" if bound > 0.3 else "allow")
    assert {r.host for r in got if r.verdict == "block"} & {f"h{i}.bad.net" for i in range(6)}
    assert not {r.host for r in got if r.verdict == "block"} - {f"h{i}.bad.net" for i in range(6)}


def test_unlabelled_hosts_take_what_is_known_above(spark):
    rows = [(f"h{i}.bad.net", True) for i in range(40)] + [(f"g{i}.good.org", False) for i in range(40)]
    pages = spark.createDataFrame([(1, "http://new.bad.net/x", ""), (2, "http://new.good.org", ""), (3, "http://else.xyz/", "")], SCHEMA)
    got = {r.page_id: r for r in judge(pages, spark.createDataFrame(rows, "host string, bad boolean")).collect()}
    assert got[1].verdict == "block" and got[2].verdict == "allow" and got[3].verdict == "allow" and got[3].bad_rate is None


def test_outcomes_come_from_the_documents_shown(spark):
    pages = spark.createDataFrame([
        (1, "http://a.net/en/5?x=6", ""), (2, "http://a.net/en/6.html#top", ""), (3, "http://b.net/7/", ""), (4, "http://b.net/en/8x", ""),
        (5, "http://c.net/en/9", ""), (6, "http://c.net/99999999999999999999", ""), (7, None, "")], SCHEMA)
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (7, 1, 1), (8, 0, 0), (5, 1, None), (None, 0, 1)], LABELS)
    assert sorted((r.host, r.bad) for r in page_outcomes(pages, labels).collect()) == [("a.net", False), ("a.net", True), ("b.net", True)]


def test_clashing_columns_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "old", 5)], "page_id long, url string, Host string, judged_host int")
    row = judge(pages, spark.createDataFrame([], "host string, bad boolean")).first()
    assert row["host"] == "a.org" and row["judged_host"] == 5
    assert judged_pages(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).count() == 0
    host, path = host_and_path(F.lit("q"))
    assert spark.range(1).select(host, path).first() == ("", "")
