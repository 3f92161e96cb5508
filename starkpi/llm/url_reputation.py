"""URL filters: explicit rules first, empirical-Bayes host reputation for the rest.

Rules are ``host/path`` strings: a rule fits its host and all subdomains when the url's path
starts with the rule's path; the longest fitting rule decides.

Where no rule fits, the host's reputation does.  Labelled page outcomes (bad or not) are
counted per host; each host's bad rate is shrunk towards its registered domain's, that
towards its suffix's, and that towards the rate of all pages, by beta-binomial priors whose
strengths are estimated from how much the groups of a level differ (moments).  A host is
blocked when the lower bound of its posterior bad rate passes ``max_bad``: a few bad pages
are not enough, a host without labels follows its domain.

Pages are read without their text, counts are partial aggregates, and what is joined back
to the pages has one row per host: broadcast up to ``BROADCAST_HOSTS`` rows, beyond that
shuffled, where AQE splits a host that holds much of the pages.  The strengths are a few
numbers, computed as scalar subqueries.

Urls that are NULL or lack ``://`` have an empty host and path; they form the host '', which
is judged like any other.  Repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkpi.llm.common import materialize

BROADCAST_HOSTS = 50_000
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp",
                      "ne.jp", "com.br", "com.cn", "com.mx", "co.in", "co.kr", "co.za", "com.tr", "com.ar"]


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where names are registered below two."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one more label."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rules_by_host(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(host, rules): the rules of each host and of its parent domains, longest first.
    ``rules``: (verdict, host/path) pairs, a configuration list."""
    spark = hosts.sparkSession
    table = spark.createDataFrame([(v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in rules],
                                  "verdict string, rule string, rule_host string, rule_path string")
    labels = F.split("host", r"\.")
    # every suffix of the host: a host has a few labels
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = hosts.select("host", F.explode(ends).alias("rule_host")).join(F.broadcast(table), "rule_host")
    item = F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "verdict")
    return chain.groupBy("host").agg(F.array_sort(F.collect_list(item)).alias("rules"))


def shrunk(groups: DataFrame, smallest: float = 1.0, largest: float = 1e6) -> DataFrame:
    """``groups`` (n, bad, mean, weight: the prior's mean and the evidence behind it) plus
    a, b: the beta posterior of each group's bad rate.

    The prior's strength is estimated from how much all groups differ: with within-group
    correlation r the expected sum of n (p - m)^2 / (m (1 - m)) is their number + r (all n -
    their number), and strength is 1 / r - 1.  It never passes the evidence behind the
    prior's mean: groups without outcomes are no surer than what they are judged by."""
    m = F.col("mean")
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - m, F.lit(2.0)) / (m * (1 - m))
    seen = groups.where((F.col("n") > 0) & (m > 0) & (m < 1))
    r = seen.agg((F.sum(spread) - F.count(F.lit(1))) / F.nullif(F.sum("n") - F.count(F.lit(1)), F.lit(0))).scalar()
    strength = F.when(r > 0, F.greatest(F.lit(smallest), F.least(F.lit(largest), 1 / r - 1))).otherwise(F.lit(largest))
    strength = F.least(strength, F.col("weight"))
    return groups.withColumn("a", F.col("bad") + strength * m).withColumn("b", F.col("n") - F.col("bad") + strength * (1 - m))


def reputation(counts: DataFrame) -> DataFrame:
    """(host, n, bad, a, b) from (host, n, bad), one row per host, labelled or not: the beta
    posterior of every host's bad rate."""
    hosts = materialize(counts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    prior = [(F.col("a") / (F.col("a") + F.col("b"))).alias("mean"), (F.col("a") + F.col("b")).alias("weight")]
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    all_mean = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1.0))).scalar()
    all_weight = hosts.agg(F.sum("n") + 1.0).scalar()
    suffixes = materialize(hosts.groupBy("suffix").agg(*sums).withColumn("mean", all_mean).withColumn("weight", all_weight))
    suffixes = materialize(shrunk(suffixes).select("suffix", *prior))
    domains = hosts.groupBy("domain").agg(*sums, F.first("suffix").alias("suffix")).join(suffixes, "suffix")
    domains = materialize(shrunk(materialize(domains)).select("domain", *prior))
    return shrunk(materialize(hosts.join(domains, "domain"))).select("host", "n", "bad", "a", "b")


def lower_bound(a: Column, b: Column, z: float = 1.645) -> Column:
    """Lower bound of a beta distribution, by its mean and standard deviation."""
    s = a + b
    return F.greatest(F.lit(0.0), a / s - F.lit(z) * F.sqrt(a * b / (s * s * (s + 1))))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], max_bad: float = 0.35,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(``id_col``, host, path, rule, verdict, reputation) per row of ``pages``.

    ``outcomes``: (``id_col``, bad boolean) of labelled pages; an id labelled twice is bad if
    either label says so.  ``reputation`` is the lower bound of the host's bad rate."""
    parsed = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = outcomes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.col("bad").cast("int")).alias("__bad"))
    labelled = parsed.join(known, F.col(id_col) == F.col("__id")).groupBy(F.col("host").alias("__host")).agg(
        F.count("__bad").alias("n"), F.sum("__bad").alias("bad"))
    every = parsed.select("host").distinct().join(labelled, F.col("host") == F.col("__host"), "left").select(
        "host", F.coalesce("n", F.lit(0)).cast("double").alias("n"), F.coalesce("bad", F.lit(0)).cast("double").alias("bad"))
    every = materialize(every)
    rep = reputation(every).select(F.col("host").alias("__host"), lower_bound(F.col("a"), F.col("b")).alias("reputation"))
    rep = rep.join(rules_by_host(every.select("host"), rules).withColumnRenamed("host", "__h"),
                   F.col("__host") == F.col("__h"), "left").drop("__h")
    rep = materialize(rep)
    if rep.count() <= BROADCAST_HOSTS:
        rep = F.broadcast(rep)
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    first = F.get(fits, F.lit(0))
    by_method = F.when(F.col("reputation") > max_bad, "block").otherwise("allow")
    return parsed.join(rep, F.col("host") == F.col("__host")).select(
        id_col, "host", "path", first["rule"].alias("rule"),
        F.coalesce(first["verdict"], by_method).alias("verdict"), "reputation")
