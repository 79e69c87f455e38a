"""URL filtering by empirical-Bayes host reputation.

Labelled pages are counted per host (good or bad). A host's bad rate gets a beta
prior centred on its registered domain's rate, that one on its suffix's, that on
the corpus's. How strong each prior is follows from how much the rates of its
level really differ (a moment estimate of the beta-binomial). A host is blocked
when the lower bound of its posterior is above the tolerated rate. Explicit rules
come first; the longest that fits decides.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.functions.stages import stage
from pitpanel.llm.common import at, fresh, sheltered

#: A host is blocked when more than this share of its pages is bad ...
TOLERATED = 0.3
#: ... with this many standard deviations to spare.
SURE = 1.645
#: Bounds on the estimated correlation of outcomes within a group.
LEAST_CORRELATION, MOST_CORRELATION = 1e-4, 0.5


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Host, path and verdict of the rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null for a null url or one without it."""
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty for a null url or one without ``://``."""
    rest = after_scheme(url)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def strength(prior: str) -> Column:
    """Aggregate: pseudo-outcomes of a beta prior for groups with n, b and a prior mean.

    The moment estimate of the correlation of two outcomes of a group: what the
    rates vary around their prior beyond chance.
    """
    n, m = F.col("n"), F.col(prior)
    spread = F.sum(n * (F.col("b") / n - m) * (F.col("b") / n - m) / (m * (1 - m)))
    count, total = F.count(F.lit(1)), F.sum(n)
    excess = spread - count
    room = total - count
    rho = F.when(room > 0, excess / room).otherwise(F.lit(MOST_CORRELATION))
    rho = F.least(F.greatest(rho, F.lit(LEAST_CORRELATION)), F.lit(MOST_CORRELATION))
    return (1 - rho) / rho


def reputations(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posterior (a, c) of the bad rate by host, domain and suffix.

    ``outcomes``: host and bad (boolean), one row per labelled page; counts are
    combined map-side, so a host with very many pages costs no more than others.
    """
    hosts = (
        outcomes.where("bad is not null").groupBy("host")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("bad").cast("double")).alias("b"))
        .withColumns({"domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1)})
    )
    hosts = stage(hosts, "hosts")
    both = [F.sum("n").alias("n"), F.sum("b").alias("b")]
    whole = hosts.agg(*both).first()
    corpus = ((whole.b or 0.0) + 1) / ((whole.n or 0.0) + 2)

    def level(groups: DataFrame, prior: str, out: str) -> DataFrame:
        groups = stage(groups, out)
        s = F.lit(groups.agg(strength(prior).alias("s")).first().s or 1.0)
        a, c = F.col("b") + s * F.col(prior), F.col("n") - F.col("b") + s * (1 - F.col(prior))
        return groups.withColumns({"a": a, "c": c, out: a / (a + c)})

    suffixes = hosts.groupBy("suffix").agg(*both).withColumn("m0", F.lit(corpus))
    suffixes = level(suffixes, "m0", "m1").select("suffix", "a", "c", "m1")
    domains = hosts.groupBy("domain", "suffix").agg(*both).join(suffixes.select("suffix", "m1"), "suffix")
    domains = level(domains, "m1", "m2").select("domain", "a", "c", "m2")
    rated = level(hosts.join(domains.select("domain", "m2"), "domain"), "m2", "m3").select("host", "a", "c")
    return rated, domains.select("domain", "a", "c"), suffixes.select("suffix", "a", "c")


def judge(
    pages: DataFrame, outcomes: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES,
    tolerated: float = TOLERATED, sure: float = SURE,
) -> DataFrame:
    """Every row of ``pages`` with host, path, rule, verdict, bad_rate and bound.

    ``outcomes``: host and bad per labelled page; null outcomes don't count. A host
    without labels takes its domain's posterior, else its suffix's, else nothing
    is held against it. Columns of ``pages`` that clash with the added ones are
    replaced. Rows without a host are judged by the empty host.
    """
    added = ["host", "path", "rule", "verdict", "bad_rate", "bound"]
    held = [c for c in pages.columns if c.lower() not in added or c == url_col]
    work = lambda rows, url: _judged(rows, url, outcomes, rules, tolerated, sure)
    return sheltered(pages.select([at(c) for c in held]), [url_col], work, added)


def _judged(
    pages: DataFrame, url_col: str, outcomes: DataFrame, rules: tuple[Rule, ...], tolerated: float, sure: float
) -> DataFrame:
    rated, domains, suffixes = reputations(outcomes)
    # Written, so that Spark knows their sizes and broadcasts small ones only.
    rated = stage(rated, "rated").toDF("h_key", "h_a", "h_c")
    domains = stage(domains, "domains").toDF("d_key", "d_a", "d_c")
    suffixes = stage(suffixes, "suffixes").toDF("s_key", "s_a", "s_c")
    held = pages.columns
    host, path = fresh(pages, "judged_host", "judged_path")
    h, p = host_and_path(at(url_col).cast("string"))
    rows = pages.select(*[at(c) for c in held], h.alias(host), p.alias(path))
    rows = (
        rows.join(rated, at(host) == F.col("h_key"), "left")
        .join(domains, F.substring_index(at(host), ".", -2) == F.col("d_key"), "left")
        .join(suffixes, F.substring_index(at(host), ".", -1) == F.col("s_key"), "left")
    )
    a, c = F.coalesce("h_a", "d_a", "s_a"), F.coalesce("h_c", "d_c", "s_c")
    rate = a / (a + c)
    bound = rate - sure * F.sqrt(rate * (1 - rate) / (a + c + 1))
    text, verdict = rule_for(at(host), at(path), rules)
    by_method = F.when(bound > tolerated, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *[at(x) for x in held], at(host).alias("host"), at(path).alias("path"), text.alias("rule"),
        F.coalesce(verdict, by_method).alias("verdict"), rate.alias("bad_rate"), bound.alias("bound"),
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host and bad per labelled page: a page shows the document whose number ends its path.

    A page is bad when that document has low quality or is toxic by any label row.
    """
    host, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html|/)?$", 1).try_cast("bigint")
    shown = pages.select(host.alias("host"), number.alias("shown")).where("shown is not null")
    marked = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return shown.join(marked, F.col("shown") == F.col("doc_id")).select("host", "bad")


def judged_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    outcomes = page_outcomes(pages.select("url"), labels)
    return judge(pages.select("page_id", "url"), outcomes).select("page_id", "host", "path", "rule", "verdict")
