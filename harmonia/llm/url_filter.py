"""URL filter by empirical-Bayes host reputation, in DataFrame functions only.

Labelled page outcomes (1 good, 0 bad) are counted by host.  Rates are shrunk from the top down
through beta-binomial priors: the corpus gives the prior of every public suffix, a suffix's posterior
mean is the prior mean of its registered domains, a domain's that of its hosts.  The strength of each
level's prior, in pseudo-observations, is fitted by moments to the spread of the rates at that level
beyond binomial noise.  A url is blocked when the upper posterior bound of its host's rate of good
outcomes stays below the least rate that is tolerated, so that a host is blocked on evidence and
never for want of it.  Rules override the reputation: of all that fit a url the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: A host is blocked if its rate of good outcomes is below this at the upper bound.
LEAST_RATE = 0.75
#: Standard deviations of the posterior at the bound (one-sided 95 %).
BOUND = 1.645
#: The prior strength is held between these many pseudo-observations.
STRENGTH = (1.0, 1e6)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_tree(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` with the registered ``domain`` and public ``suffix`` of its column host.

    Ports belong to neither, and an address (IPv4, or in brackets) is its own domain and suffix.  A suffix is the longest of ``suffixes``
    (suffix: lower-case, without a leading dot, such as ``co.uk``) that ends the host, else the last label; the
    domain has one label more, as far as there is one.
    """
    bare = F.regexp_replace("host", r":\d*$", "")
    address = bare.rlike(r"^(\d{1,3}(\.\d{1,3}){3}|\[.*)$")
    parts = hosts.withColumn("_bare", bare).withColumn("_address", address)
    if suffixes is None:
        parts = parts.withColumn("_labels", F.lit(1))
    else:
        ends = F.expr("transform(sequence(1, size(split(_bare, '[.]'))), i -> struct(i AS labels, substring_index(_bare, '.', -i) AS suffix))")
        found = (parts.where(~F.col("_address")).select("host", F.explode(ends).alias("_e")).select("host", "_e.*")
                 .join(suffixes.select("suffix").distinct(), "suffix").groupBy("host").agg(F.max("labels").alias("_found")))
        parts = parts.join(found, "host", "left").withColumn("_labels", F.coalesce("_found", F.lit(1))).drop("_found")
    domain, suffix = F.expr("substring_index(_bare, '.', -(_labels + 1))"), F.expr("substring_index(_bare, '.', -_labels)")
    return (parts.withColumn("domain", F.when(F.col("_address"), F.col("_bare")).otherwise(domain))
            .withColumn("suffix", F.when(F.col("_address"), F.col("_bare")).otherwise(suffix)).drop("_bare", "_address", "_labels"))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; equal lengths go to the earlier rule."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(rates: DataFrame) -> Column:
    """Pseudo-observations of a level's beta prior by moments, from rows (n, good, mean).

    With d = good - n * mean, E[d^2] = n m (1 - m) (1 + (n - 1) rho) and the strength is 1 / rho - 1.
    """
    noise = F.col("n") * F.col("mean") * (1 - F.col("mean"))
    d2 = F.pow(F.col("good") - F.col("n") * F.col("mean"), F.lit(2.0))
    rho = (F.sum(d2) - F.sum(noise)) / F.nullif(F.sum(noise * (F.col("n") - 1)), F.lit(0.0))
    strength = F.when(rho <= 1 / (STRENGTH[1] + 1), F.lit(STRENGTH[1])).otherwise(1 / rho - 1)
    return F.coalesce(F.least(F.lit(STRENGTH[1]), F.greatest(F.lit(STRENGTH[0]), strength)), F.lit(STRENGTH[1]))


def _shrunk(level: DataFrame, key: str) -> DataFrame:
    """``level`` (key, n, good, mean) with the posterior of each key's rate: mean ``rate`` and ``deviation``."""
    strength = F.lit(level.agg(_strength(level)).first()[0])   # one number
    a = F.col("mean") * strength + F.col("good")
    total = strength + F.col("n")
    return level.withColumn("rate", a / total).withColumn(
        "deviation", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))).select(
        key, "n", "good", "rate", "deviation", strength.alias("strength"))


def host_reputation(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """Posterior rates of ``hosts`` (host, n, good: counts of labelled outcomes, n 0 if unlabelled); ``suffixes`` as in ``host_tree``.

    Returns host, n, good, rate, deviation, strength.  Without a single outcome the corpus rate is one half.
    The driver takes four numbers: the corpus rate and the strength of each level.  ``hosts`` is read for
    each of them, so it should be a written table.
    """
    tree = host_tree(hosts, suffixes).select("host", "domain", "suffix", "n", "good")
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes, domains = tree.groupBy("suffix").agg(*sums), tree.groupBy("domain", "suffix").agg(*sums)
    overall = F.lit(hosts.agg((F.coalesce(F.sum("good"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).first()[0])
    s = _shrunk(suffixes.withColumn("mean", overall), "suffix").select("suffix", F.col("rate").alias("mean"))
    d = _shrunk(domains.join(s, "suffix"), "domain").select("domain", F.col("rate").alias("mean"))
    return _shrunk(tree.join(d, "domain"), "host")


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, least_rate: float = LEAST_RATE, bound: float = BOUND,
          suffixes: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's rate and upper bound for every row of ``pages`` (page_id, url).

    ``outcomes`` holds (page_id, good): 1, 0 or null (no outcome); a page with several keeps the worst, and
    each row of a repeated page counts.  Other columns are left out whatever their names.  ``suffixes`` names public suffixes of several labels.  Urls without a host share the empty host.  An empty table gives no
    rows.  Pages are reduced to (page_id, host) before the shuffle, and outcomes to counts by host before
    the next, so a host with a third of all pages is a row a task.
    """
    of = outcomes.where(F.col("page_id").isNotNull()).groupBy(F.col("page_id").alias("of_page")).agg(F.min("good").cast("long").alias("good"))
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    hosts = (parsed.select("page_id", "host").join(of, F.col("page_id") == F.col("of_page"), "left")
             .groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")))
    reputation = host_reputation(materialise(hosts, "url-hosts"), suffixes).select(
        F.col("host").alias("of_host"), "n", F.col("rate").alias("host_rate"),
        F.least(F.lit(1.0), F.col("rate") + F.lit(bound) * F.col("deviation")).alias("host_bound"))
    judged = parsed.join(reputation, F.col("host") == F.col("of_host")).withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.round("host_bound", 9) < least_rate, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), F.coalesce("fits.verdict", method).alias("verdict"),
                         F.col("n").alias("host_outcomes"), F.round("host_rate", 9).alias("host_rate"), F.round("host_bound", 9).alias("host_bound"))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    """``labels`` supplies the outcomes: the quality of the document with the page's id."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes)


_LEVEL = """
{name} AS (
  SELECT l.*, (mean * strength + good) / (strength + n) AS rate, strength + n AS total
  FROM {rows} l, (
    SELECT coalesce(least(1e6, greatest(1.0, CASE WHEN rho <= 1 / (1e6 + 1) THEN 1e6 ELSE 1 / rho - 1 END)), 1e6) AS strength
    FROM (SELECT (sum(pow(good - n * mean, 2)) - sum(n * mean * (1 - mean))) / nullif(sum(n * mean * (1 - mean) * (n - 1)), 0) AS rho FROM {rows})
  )
)"""

ORACLE_SQL = r"""
WITH parsed AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), outcome AS (
  SELECT doc_id, min(quality) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), hosts AS (
  SELECT host, CASE WHEN regexp_matches(regexp_replace(host, ':\d*$', ''), '^(\d{1,3}(\.\d{1,3}){3}|\[.*)$') THEN [regexp_replace(host, ':\d*$', '')]
           ELSE string_split(regexp_replace(host, ':\d*$', ''), '.') END AS parts, count(good) AS n, coalesce(sum(good), 0) AS good
  FROM parsed LEFT JOIN outcome ON page_id = doc_id GROUP BY host
), tree AS (
  SELECT host, array_to_string(parts[-2:], '.') AS domain, parts[-1] AS suffix, n, good FROM hosts
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good, (SELECT (sum(good) + 0.5) / (sum(n) + 1) FROM tree) AS mean FROM tree GROUP BY suffix
),""" + _LEVEL.format(name="by_suffix", rows="suffixes") + r""", domains AS (
  SELECT domain, t.suffix, sum(t.n) AS n, sum(t.good) AS good, any_value(s.rate) AS mean FROM tree t JOIN by_suffix s USING (suffix) GROUP BY domain, t.suffix
),""" + _LEVEL.format(name="by_domain", rows="domains") + r""", leaves AS (
  SELECT t.host, t.n, t.good, d.rate AS mean FROM tree t JOIN by_domain d USING (domain)
),""" + _LEVEL.format(name="by_host", rows="leaves") + r""", bounded AS (
  SELECT host, n, rate, least(1.0, rate + 1.645 * sqrt(rate * (1 - rate) / (total + 1))) AS upper FROM by_host
), judged AS (
  SELECT page_id, p.host, p.path, n, rate, upper, CASE
    WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(p.path, '/en/1') THEN 'example.org/en/1'
    WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(p.path, '/es/') THEN 'example.org/es/'
    WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(p.path, '/fr/') THEN 'com/fr/'
    WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(p.path, '/de/') THEN 'com/de/'
    WHEN (p.host = 'org' OR ends_with(p.host, '.org')) AND starts_with(p.path, '/') THEN 'org/' END AS rule
  FROM parsed p JOIN bounded b ON p.host = b.host
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN round(upper, 9) < 0.75 THEN 'block' ELSE 'allow' END AS verdict,
       n AS host_outcomes, round(rate, 9) AS host_rate, round(upper, 9) AS host_bound
FROM judged
"""
