"""URL filter: rules first, then empirical-Bayes reputation of the host. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.llm.columns import unused
from tradewind.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # "allow" or "block"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL and for text without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULL without one. Ties go to the first by text.

    A rule fits its host and all subdomains if the path starts with the rule's. Rules are settings, not
    data: at most ``MOST_RULES``.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _strength(units: DataFrame, least: float, most: float) -> float:
    """Prior strength (alpha + beta) from ``units(n, good, prior)`` by the method of moments.

    Beta-binomial counts vary more than binomial ones by ``1 + (n - 1) * rho``; strength is
    ``1 / rho - 1``. Without any unit of two outcomes there is nothing to tell: the least is taken.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    over, scale = units.agg(
        F.sum(F.pow(F.col("good") - F.col("n") * F.col("prior"), 2) - F.col("n") * spread),
        F.sum(F.col("n") * (F.col("n") - 1) * spread),
    ).first()
    if not scale:
        return least
    rho = (over or 0.0) / scale
    return most if rho <= 0 else min(most, max(least, 1 / rho - 1))


def _posterior(level: DataFrame, strength: float) -> DataFrame:
    """``mean`` and ``var`` of each unit; what is not known of the prior's mean (``prior_var``) counts too."""
    total = F.col("n") + strength
    return level.withColumn("mean", (F.col("good") + strength * F.col("prior")) / total).withColumn(
        "var",
        F.col("mean") * (1 - F.col("mean")) / (total + 1) + F.pow(F.lit(strength) / total, 2) * F.col("prior_var"),
    )


def host_reputation(
    outcomes: DataFrame, quantile: float = 2.33, least_strength: float = 1.0, most_strength: float = 1000.0
) -> DataFrame:
    """``host, n, good, mean, bound``: how good pages of a host are, from labelled outcomes.

    ``outcomes(host, outcome)`` has 1 for a good page, 0 for a bad one and NULL for an unknown one;
    every host in it gets a row. A host is shrunk to its registered domain (its last two labels), that
    to its suffix (the last label), and that to the mean of all outcomes (0.5 without any). Each
    level's prior strength is fitted to the counts of that level. ``bound`` is the mean plus
    ``quantile`` standard deviations of the host's posterior, the parents' included.

    Pages are counted per host before anything is shuffled, so that a host with a third of all rows
    costs one row per task. A NULL host is the empty host.
    """
    labels = F.split(F.col("host"), r"\.")
    hosts = stored(
        outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host"))
        .agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("good"))
        .withColumn("suffix", F.element_at(labels, -1))
        .withColumn("domain", F.when(F.size(labels) < 2, F.col("host")).otherwise(F.concat_ws(".", F.slice(labels, -2, 2))))
    )
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    overall = good / n if n else 0.5
    counts = (F.sum("n").alias("n"), F.sum("good").alias("good"))

    suffixes = hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(float(overall)))
    suffixes = suffixes.withColumn("prior_var", F.lit(0.0))
    suffixes = _posterior(suffixes, _strength(suffixes, least_strength, most_strength))
    above = (F.col("mean").alias("prior"), F.col("var").alias("prior_var"))
    domains = hosts.groupBy("suffix", "domain").agg(*counts).join(suffixes.select("suffix", *above), "suffix")
    domains = _posterior(domains, _strength(domains, least_strength, most_strength))
    hosts = hosts.join(domains.select("suffix", "domain", *above), ["suffix", "domain"])
    hosts = _posterior(hosts, _strength(hosts, least_strength, most_strength))
    return hosts.select("host", "n", "good", "mean", (F.col("mean") + quantile * F.sqrt("var")).alias("bound"))


def judge(pages: DataFrame, rules: list[Rule], threshold: float = 0.5, quantile: float = 2.33) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` added (columns of these names are replaced).

    The longest fitting rule decides. Its verdicts are also the labelled outcomes that hosts are judged
    by; a page without a rule is blocked if the upper posterior bound of its host's good share is
    below ``threshold``: with the default ``quantile`` 99 % sure by the normal approximation, which is less for
    hosts with few outcomes, whose beta is skewed. A host without outcomes has its domain's reputation, with all that is not known about it. NULL urls have an empty host, which is
    judged like any other. Every row of ``pages`` comes back once, repeated ones too.
    """
    host, path = host_and_path(F.col("url"))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    ruled_by, judged_by = unused(kept, "_ruled"), unused(kept, "_judged")
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("rule", rule).withColumn(ruled_by, ruled)
    outcome = F.when(F.col(ruled_by) == "allow", 1).when(F.col(ruled_by) == "block", 0)
    known = host_reputation(parsed.select("host", outcome.alias("outcome")), quantile)
    judged = known.select("host", F.when(F.col("bound") < threshold, "block").otherwise("allow").alias(judged_by))
    return parsed.join(judged, "host", "left").select(
        *kept, "host", "path", "rule", F.coalesce(ruled_by, judged_by).alias("verdict")
    )


#: The rules of query op4 (fixed values).
RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]

SQL = """
WITH rules(host, path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parsed AS (SELECT page_id, row_number() OVER () AS r,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
ruled AS (SELECT p.r, max_by(u.host || u.path, length(u.host || u.path)) AS rule,
    max_by(u.verdict, length(u.host || u.path)) AS verdict
    FROM parsed p JOIN rules u ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path)
    GROUP BY p.r),
pages_ AS (SELECT p.*, u.rule, u.verdict AS ruled FROM parsed p LEFT JOIN ruled u USING (r)),
hosts AS (SELECT host, count(ruled) AS n, count(*) FILTER (ruled = 'allow') AS good,
    list_extract(string_split(host, '.'), -1) AS suffix,
    CASE WHEN strpos(host, '.') = 0 THEN host
      ELSE list_extract(string_split(host, '.'), -2) || '.' || list_extract(string_split(host, '.'), -1) END AS domain
    FROM pages_ GROUP BY host),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good,
    (SELECT CASE WHEN sum(n) > 0 THEN sum(good) / sum(n) ELSE 0.5 END FROM hosts) AS prior FROM hosts GROUP BY suffix),
sk AS (SELECT CASE WHEN coalesce(scale, 0) = 0 THEN 1.0 WHEN ov <= 0 THEN 1000.0
      ELSE least(1000.0, greatest(1.0, scale / ov - 1)) END AS k
    FROM (SELECT sum((good - n * prior) ** 2 - n * prior * (1 - prior)) AS ov,
      sum(n * (n - 1) * prior * (1 - prior)) AS scale FROM s0)),
s1 AS (SELECT suffix, mean, mean * (1 - mean) / (total + 1) AS var
    FROM (SELECT suffix, (good + k * prior) / (n + k) AS mean, n + k AS total FROM s0, sk)),
d0 AS (SELECT h.suffix, h.domain, sum(h.n) AS n, sum(h.good) AS good, any_value(s1.mean) AS prior,
    any_value(s1.var) AS prior_var
    FROM hosts h JOIN s1 USING (suffix) GROUP BY h.suffix, h.domain),
dk AS (SELECT CASE WHEN coalesce(scale, 0) = 0 THEN 1.0 WHEN ov <= 0 THEN 1000.0
      ELSE least(1000.0, greatest(1.0, scale / ov - 1)) END AS k
    FROM (SELECT sum((good - n * prior) ** 2 - n * prior * (1 - prior)) AS ov,
      sum(n * (n - 1) * prior * (1 - prior)) AS scale FROM d0)),
d1 AS (SELECT suffix, domain, mean, mean * (1 - mean) / (total + 1) + (k / total) ** 2 * prior_var AS var
    FROM (SELECT *, (good + k * prior) / (n + k) AS mean, n + k AS total FROM d0, dk)),
h0 AS (SELECT h.host, h.n, h.good, d1.mean AS prior, d1.var AS prior_var FROM hosts h JOIN d1 USING (suffix, domain)),
hk AS (SELECT CASE WHEN coalesce(scale, 0) = 0 THEN 1.0 WHEN ov <= 0 THEN 1000.0
      ELSE least(1000.0, greatest(1.0, scale / ov - 1)) END AS k
    FROM (SELECT sum((good - n * prior) ** 2 - n * prior * (1 - prior)) AS ov,
      sum(n * (n - 1) * prior * (1 - prior)) AS scale FROM h0)),
h1 AS (SELECT host, mean, mean * (1 - mean) / (total + 1) + (k / total) ** 2 * prior_var AS var
    FROM (SELECT *, (good + k * prior) / (n + k) AS mean, n + k AS total FROM h0, hk))
SELECT p.page_id, p.host, p.path, p.rule,
    coalesce(p.ruled, CASE WHEN h1.mean + 2.33 * sqrt(h1.var) < 0.5
      THEN 'block' ELSE 'allow' END) AS verdict
FROM pages_ p JOIN h1 USING (host)
"""
