"""URL filters: fixed rules first, then Empirical-Bayes reputation of the host.

A page is good if its label says quality 1 and toxic 0; page_id and doc_id are the same numbers.
Outcomes are counted by host. The share of good pages of a suffix is shrunk towards the share of
all, that of a registered domain (the last two names) towards its suffix, that of a host
towards its domain, each through a beta prior whose strength is estimated from the spread between the
groups of its level. A page is blocked if even the upper posterior bound of its host lies below
``MIN_GOOD``. Only counts are shuffled before the final join, whose hot hosts the
adaptive planner can split; three numbers reach the driver.

Defined results: host and path of a NULL url or one without ``://`` are empty, and such pages
share the reputation of the empty host; repeated rows are judged alike; a page counts as good only if
all labels of its id say so; NULL labels count for nothing. Without labels all pages that no rule blocks are allowed.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.sources.settle import settle

# Rules as (verdict, host and path). A bounded list: each is a test in the plan.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
Z = 1.645
MIN_GOOD = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or NULL; of equally long ones the first in order."""
    found = F
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        found = found.when(_fits(rule, host, path), F.lit(rule))
    return found if isinstance(found, Column) else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    cases = [F.when(rule == name, F.lit(verdict)) for verdict, name in rules]
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def _counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from ``good``, ``n`` and the parent's share ``prior``.

    In a beta-binomial the groups' squared distances exceed the binomial's by the
    correlation 1 / (strength + 1) times n - 1: the moment estimate, within bounds.
    """
    share = F.col("good") / F.col("n")
    noise = F.col("prior") * (1 - F.col("prior"))
    excess, room = groups.where("n > 0").agg(
        F.sum(F.col("n") * (share - F.col("prior")) * (share - F.col("prior")) - noise),
        F.sum(noise * (F.col("n") - 1)),
    ).first()
    if not room or excess <= 0:
        return MAX_STRENGTH
    return min(max(room / excess - 1, MIN_STRENGTH), MAX_STRENGTH)


def _shrunk(groups: DataFrame, name: str) -> DataFrame:
    """Posterior mean of each group from its counts and ``prior``."""
    k = _strength(groups)
    return groups.withColumn(name, (F.col("good") + k * F.col("prior")) / (F.col("n") + k)).drop("prior")


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Each host with the number of labelled pages, posterior mean and upper bound."""
    outcome = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("bigint")).alias("good"))
    )
    seen = pages.select("page_id", host_of(F.col("url")).alias("host")).join(outcome, "page_id", "left")
    counted = seen.groupBy("host").agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n")
    )
    domain = F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0)
    suffix = F.regexp_extract("host", r"[^.]*$", 0)
    hosts = settle(counted.select("*", domain.alias("domain"), suffix.alias("suffix")))
    domains = settle(_counts(hosts, ["suffix", "domain"]))
    suffixes = settle(_counts(domains, ["suffix"]))
    good, n = suffixes.agg(F.sum("good"), F.sum("n")).first()
    start = good / n if n else 1.0
    top = _shrunk(suffixes.withColumn("prior", F.lit(start)), "mean").select("suffix", F.col("mean").alias("prior"))
    middle = _shrunk(domains.join(top, "suffix"), "mean").select("domain", F.col("mean").alias("prior"))
    placed = hosts.join(middle, "domain")
    k = _strength(placed)
    a = F.col("good") + k * F.col("prior")
    total = F.col("n") + k
    mean = a / total
    return placed.select(
        "host",
        "n",
        mean.alias("mean"),
        (mean + Z * F.sqrt(mean * (1 - mean) / (total + 1))).alias("upper"),
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    bounds = host_reputation(pages, labels).select("host", "upper")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("upper") < MIN_GOOD, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), own)
    return rows.join(bounds, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
