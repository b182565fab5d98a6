"""URL filters: host and path rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (good or not) are counted per host, registered domain and suffix.  Each level is a beta-binomial
model whose mean is the posterior of the level above it and whose strength is estimated from how much the groups of that
level vary (moments): global -> suffix -> domain -> host.  A host passes if the lower bound of its posterior (mean less
``Z`` standard deviations) reaches ``LEAST``; hosts without labels lean on their domain, suffix or the whole.

Built-in functions only.  Labels are counted per host before anything is joined; levels above hosts are sums of host rows.

Cases: NULL urls and urls without :// have an empty host and path; repeated pages count each; without labels the prior is
an even one; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, freeze

# Verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LEAST = 0.5
Z = 2.0
_STRENGTH = (1.0, 1000.0)  # of a prior, in pages


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULLs if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _shrunk(groups: DataFrame, level: str) -> DataFrame:
    """Adds ``p_<level>`` and ``m_<level>`` to groups with n, k and the parent's mean ``p``: posterior means of one level.

    The strength m comes from one row of sums over all groups of the level, which is what is broadcast.
    """
    own = F.col("k") / F.col("n")
    var = F.col("p") * (1 - F.col("p"))
    sums = groups.where("n > 0").agg(
        F.sum(F.col("n") * (own - F.col("p")) * (own - F.col("p"))).alias("s"),
        F.avg(var).alias("v"), F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
    )
    spread = F.col("n") - F.col("n2") / F.col("n") - (F.col("g") - 1)
    rho = F.try_divide(F.col("s") / F.col("v") - (F.col("g") - 1), spread)
    most = 1 / (1 + _STRENGTH[0])
    least = 1 / (1 + _STRENGTH[1])
    rho = F.least(F.lit(most), F.greatest(F.lit(least), F.coalesce(F.when(F.col("v") > 0, rho), F.lit(least))))
    strength = sums.select(((1 - rho) / rho).alias(f"m_{level}"))
    m = F.col(f"m_{level}")
    return groups.join(F.broadcast(strength)).withColumn(f"p_{level}", (F.col("k") + m * F.col("p")) / (F.col("n") + m))


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``outcomes`` (host, good boolean or NULL) to one row per host: host, n_labels, n_good, p_host, low."""
    good = F.col("good")
    hosts = outcomes.groupBy("host").agg(F.count(good).alias("n"), F.count(F.when(good, 1)).alias("k"))
    hosts = hosts.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    hosts = freeze(hosts, "url-hosts")  # each level starts from written tables, so none is computed again for the next one
    add = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = freeze(hosts.groupBy("domain", "suffix").agg(*add), "url-domains")
    suffixes = freeze(domains.groupBy("suffix").agg(*add), "url-suffixes")
    overall = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("p"))
    up = _shrunk(freeze(suffixes.join(F.broadcast(overall)), "url-up"), "suffix")
    mid = _shrunk(freeze(domains.join(up.select("suffix", F.col("p_suffix").alias("p")), "suffix"), "url-mid"), "domain")
    low = _shrunk(freeze(hosts.join(mid.select("domain", "suffix", F.col("p_domain").alias("p")), ["domain", "suffix"]), "url-low"), "host")
    p = F.col("p_host")
    bound = p - z * F.sqrt(p * (1 - p) / (F.col("n") + F.col("m_host") + 1))
    return low.select("host", F.col("n").alias("n_labels"), F.col("k").alias("n_good"), "p_host", bound.alias("low"))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, least: float = LEAST,
    z: float = Z, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, host_labels, host_good.  ``outcomes``: id, good."""
    host, path = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("_page"), host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col(id_col).alias("_page"), "good")
    standing = host_reputation(urls.select("_page", "host").join(known, "_page", "left"), z)
    text, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("low") >= least, "allow").otherwise("block")
    return urls.join(standing, "host").select(
        F.col("_page").alias(id_col), "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        F.col("n_labels").alias("host_labels"), F.col("n_good").alias("host_good"),
    )
