"""URL filter: rules first, then a reputation of the host by empirical Bayes.

Labelled page outcomes are counted per host. A host's chance of good pages is shrunk
to that of its registered domain, the domain's to that of its suffix, and the
suffix's to the mean of all, each through a beta-binomial prior whose strength is
estimated from the spread between the groups of that level. A host is allowed if
the lower bound of its posterior is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import saved, small

#: Suffixes of two labels under which domains are registered; fixed examples, all others have one label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
#: Standard deviations that the posterior mean must lie above ``LEAST_GOOD``.
MARGIN = 1.645
LEAST_GOOD = 0.5
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: the host in lower case and the path; else empty."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """The registered domain, a suffix and the label before it, and the suffix."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*LONG_SUFFIXES)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), F.when(long, two).otherwise(F.substring_index(host, ".", -1))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def strength(children: DataFrame, parent: list[str]) -> float:
    """The prior strength for groups (n, k) within their parent, by analysis of variance.

    With a correlation r of outcomes in a group beyond that in its parent, the prior counts
    as (1 - r) / r pages. Without two groups in any parent it is the strongest.
    """
    sums = children.groupBy(*parent).agg(
        F.count("*").alias("g"),
        F.sum("n").alias("n"),
        F.sum("k").alias("k"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("k2"),
    ).filter("n > 0")
    total = sums.agg(
        F.sum(F.col("g") - 1).alias("free"),
        F.sum(F.col("n") - F.col("g")).alias("rest"),
        F.sum(F.col("k2") - F.col("k") * F.col("k") / F.col("n")).alias("between"),
        F.sum(F.col("k") - F.col("k2")).alias("inside"),
        F.sum(F.col("n") - F.col("n2") / F.col("n")).alias("spread"),
    )
    free = F.nullif(F.col("free"), F.lit(0))
    between, inside = F.col("between") / free, F.col("inside") / F.greatest(F.col("rest"), F.lit(1))
    size = F.col("spread") / free
    r = (between - inside) / F.nullif(between + (size - 1) * inside, F.lit(0.0))
    pages = F.least(F.greatest((1 - r) / F.nullif(r, F.lit(0.0)), F.lit(WEAKEST)), F.lit(STRONGEST))
    return total.select(F.when(between > inside, pages).otherwise(STRONGEST)).first()[0]


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, mean, bound) from labelled (host, good) rows; good is 0 or 1, nulls are left out."""
    domain, suffix = domain_and_suffix(F.col("host"))
    labelled = outcomes.filter("good is not null and host is not null")
    hosts = saved(
        labelled.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("k")).withColumn("domain", domain).withColumn("suffix", suffix)
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    mean = suffixes.agg(F.sum("k") / F.sum("n")).first()[0] or 0.0
    c1, c2, c3 = strength(suffixes, []), strength(domains, ["suffix"]), strength(hosts, ["domain"])

    def shrunk(n: Column, k: Column, prior: Column, c: float) -> Column:
        return (k + F.lit(c) * prior) / (n + F.lit(c))

    by_suffix = suffixes.select("suffix", shrunk(F.col("n"), F.col("k"), F.lit(mean), c1).alias("suffix_mean"))
    by_domain = domains.join(small(by_suffix), "suffix").select("domain", shrunk(F.col("n"), F.col("k"), F.col("suffix_mean"), c2).alias("domain_mean"))
    found = hosts.join(small(by_domain), "domain").withColumn("a", F.col("k") + F.lit(c3) * F.col("domain_mean"))
    found = found.withColumn("b", F.col("n") - F.col("k") + F.lit(c3) * (1 - F.col("domain_mean")))
    total = F.col("a") + F.col("b")
    deviation = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    return found.select("host", (F.col("a") / total).alias("mean"), (F.col("a") / total - MARGIN * deviation).alias("bound"))


def judged(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, bound) for every row of pages.

    outcomes has (url, good) of labelled pages. ``rules`` is a short list of (host, path,
    verdict); a rule fits its host and all subdomains if the path starts with the rule's,
    and the longest decides. Without one the verdict is allow if the host's lower bound
    reaches ``LEAST_GOOD``. Null urls and urls without ``://`` have an empty host, which is a host
    like others; a host without labelled pages has no bound and is blocked. Rows are
    answered one by one, whatever their ids.
    """
    host, path = host_and_path(F.col("url"))
    labelled = outcomes.select(F.col(outcomes.columns[0]).alias("url"), F.col(outcomes.columns[1]).alias("good"))
    known = saved(reputations(labelled.select(host.alias("host"), "good")))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= LEAST_GOOD, "allow").otherwise("block")
    return rows.join(small(known), "host", "left").select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bound")
