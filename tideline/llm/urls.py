"""URL filters: allow and block rules, then empirical-Bayes host reputation. DataFrame functions only.

Labelled outcomes of pages are counted per host, registered domain and suffix. The good rate of a
suffix is shrunk towards that of all outcomes, a domain's towards its suffix, a host's towards its
domain, each by a beta prior whose weight the data give: the method of moments on the rates of a
level. A url is blocked when the lower bound of its host's posterior good rate is under a limit;
a host without outcomes has its domain's posterior, a domain without any its suffix's, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.shared import stored

#: Fixed values of the task: host suffix, path start, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Suffixes of two parts under which names are registered; all others have one part.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz", "com.cn")
GOOD_RATE = 0.5     # least good rate that the bound must reach
DEVIATIONS = 1.0    # posterior standard deviations below the mean
WEIGHTS = (2.0, 1000.0)   # limits of a prior's weight in outcomes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ? # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. Longest: the most
    characters of host and path together; of equally long ones the one with the longer host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for suffix, start, word in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(start)
        rule = F.when(fits, F.lit(suffix + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def host_counts(own: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Every host of ``own`` (page_id, host) once: host, domain, suffix, n outcomes (0 if none), good ones.

    ``outcomes``: page_id and good (0 or 1; null is no outcome). They are added up per page before
    the join and per host behind it, so neither a hot page nor a hot host gathers rows.
    """
    per_page = outcomes.groupBy("page_id").agg(F.count("good").alias("n"), F.sum(F.col("good").cast("double")).alias("good"))
    hosts = own.join(per_page, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"))
    return hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))


def _weight(level: DataFrame) -> float:
    """Outcomes a prior is worth, from how rates vary around ``prior`` within a level: one number.

    With n outcomes each, rates around m vary by m(1-m)(1/n + (1-1/n)/(weight+1)); summing
    n(rate-m)^2 over the level and solving gives the weight.
    """
    n, m = F.col("n"), F.col("prior")
    spread = F.sum(n * F.pow(F.col("good") / n - m, F.lit(2)))
    unit = F.sum(m * (1 - m))
    many = F.sum(m * (1 - m) * (n - 1))
    share = (spread - unit) / many
    weight = F.when((many > 0) & (share > 0), 1 / share - 1)
    found = level.where("n > 0").agg(weight.alias("weight")).first()[0]
    return min(max(WEIGHTS[1] if found is None else found, WEIGHTS[0]), WEIGHTS[1])


def _judged(level: DataFrame, key: str) -> DataFrame:
    """key, mean and reputation of a level's rows (key, n, good, and of what is above: prior, above)."""
    weight = _weight(level)
    alpha = weight * F.col("prior") + F.col("good")
    beta = weight * (1 - F.col("prior")) + F.col("n") - F.col("good")
    seen = F.col("n") > 0
    return level.select(key, F.when(seen, alpha / (alpha + beta)).otherwise(F.col("prior")).alias("mean"),
                        F.when(seen, bound(alpha, beta)).otherwise(F.col("above")).alias("reputation"))


def host_reputation(counts: DataFrame) -> DataFrame:
    """host and reputation, the lower posterior bound, of every host of ``counts`` (see ``host_counts``).

    Every level is stored once, with the mean and bound of the level above beside its counts; only
    single numbers (totals, weights) come to the driver.
    """
    counts = stored(counts)
    good, n = counts.agg(F.coalesce(F.sum("good"), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    alpha, beta = F.lit(good + 1.0), F.lit(n - good + 1.0)
    sums = F.sum("n").alias("n"), F.sum("good").alias("good")
    above = lambda level, key: level.select(key, F.col("mean").alias("prior"), F.col("reputation").alias("above"))

    suffixes = counts.groupBy("suffix").agg(*sums).withColumn("prior", alpha / (alpha + beta)).withColumn("above", bound(alpha, beta))
    suffixes = _judged(stored(suffixes), "suffix")
    domains = counts.groupBy("domain", "suffix").agg(*sums).join(above(suffixes, "suffix"), "suffix")
    domains = _judged(stored(domains), "domain")
    return _judged(stored(counts.join(above(domains, "domain"), "domain")), "host").select("host", "reputation")


def bound(alpha: Column, beta: Column) -> Column:
    """Lower posterior bound: mean less DEVIATIONS standard deviations of the beta."""
    total = alpha + beta
    mean = alpha / total
    return mean - DEVIATIONS * F.sqrt(mean * (1 - mean) / (total + 1))


def url_verdicts(pages: DataFrame, outcomes: DataFrame, rules=RULES, good_rate: float = GOOD_RATE) -> DataFrame:
    """Host, path, rule and verdict of every page; one row per input row.

    ``pages`` needs page_id and url, ``outcomes`` page_id and good; other columns are ignored.
    A page with several outcomes counts with each. Null urls and urls without :// have an empty
    host and path, which no rule fits; they are judged by the reputation of the empty host.
    Without any outcomes the prior is even odds: the bound is under one half, so all else is blocked.
    """
    own = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Every distinct host gets its bound once; pages only look it up.
    known = host_reputation(host_counts(own.select("page_id", "host"), outcomes.select("page_id", "good")))

    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = own.join(known, "host").withColumn("rule", rule)
    method = F.when(F.col("reputation") >= good_rate, F.lit("allow")).otherwise(F.lit("block"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce(verdict, method).alias("verdict"), "reputation")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_verdicts(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")
