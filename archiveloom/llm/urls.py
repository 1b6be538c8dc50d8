"""URL filters (4): empirical-Bayes host reputation, under explicit rules.

Labelled page outcomes (bad or not) are counted per host, registered domain and public suffix.
Each level's bad rate gets a beta prior whose mean is the posterior mean one level up (host from
registered domain, domain from suffix, suffix from all pages) and whose weight is estimated from
the data: the intra-class correlation of outcomes within groups, by the method of moments. A
page is blocked if the lower bound of its host's posterior, mean minus ``z`` standard deviations,
lies above ``max_bad``. A host without labels has its domain's mean and, having no counts of its
own, the widest posterior.

Rules (host part with path prefix, allow or block) come first; of several that fit, the longest.

Defined results: a NULL URL or one without ``://`` has empty host and path, fits no rule and is
judged by the prior of all pages; a label counts once per row; repeated page rows are judged
alike; no labels at all give the mean 0 and no block; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archiveloom.staging import StagingArea

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Public suffixes under which domains are registered, besides a host's last label; a caller
# brings a longer list as a table.
SUFFIXES = ("example.com", "example.net", "example.org", "co.uk", "com.au", "co.jp")


def host_and_path(url: str) -> tuple[Column, Column]:
    """What lies between ``://`` and ``/``, ``?``, ``#`` or the end; then up to ``?`` or ``#``."""
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    return F.translate(part(r"(?s)^.*?://([^/?#]*)"), UPPER, LOWER), part(r"(?s)^.*?://[^/?#]*([^?#]*)")


def with_levels(hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Adds ``suffix`` and ``domain`` to a table with ``host``."""
    labels = F.split("host", r"\.")
    tail = lambda n: F.array_join(F.slice(F.col("_labels"), -F.least(F.size("_labels"), n), F.least(F.size("_labels"), n)), ".")
    known = F.filter(F.sequence(F.lit(1), F.size("_labels")), lambda i: tail(i).isin(*suffixes))
    return (
        hosts.withColumn("_labels", labels)
        .withColumn("_n", F.coalesce(F.array_max(known), F.lit(1)))
        .withColumn("suffix", tail(F.col("_n")))
        .withColumn("domain", tail(F.col("_n") + 1))
        .drop("_labels", "_n")
    )


def prior_weight(groups: DataFrame) -> float:
    """Weight, in pages, of the prior of groups (n, bad, prior).

    With m the prior mean, the squared deviations sum n (bad / n - m)^2 are expected to be
    sum m (1 - m) (1 + (n - 1) rho). That gives rho, kept within [0.001, 0.9]; the weight is
    1 / rho - 1.
    """
    noise = F.col("prior") * (1 - F.col("prior"))
    found = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), F.lit(2.0))).alias("s"),
        F.sum(noise).alias("e"),
        F.sum((F.col("n") - 1) * noise).alias("d"),
    ).first()
    rho = (found["s"] - found["e"]) / found["d"] if found["d"] else 0.0
    return 1 / min(0.9, max(0.001, rho)) - 1


def reputation(outcomes: DataFrame, hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(host, n, bad, alpha, beta, mean) for every row of ``hosts`` (distinct ``host``).

    ``outcomes`` are (host, bad) with bad 0 or 1. They are counted per host once, with partial
    sums, so a host with most pages is no heavier than another; only four numbers reach the
    driver.
    """
    staging = StagingArea(hosts.sparkSession, "reputation")
    per_host = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    counts, seen = staging.write(with_levels(per_host, suffixes), "hosts", n=F.sum("n"), bad=F.sum("bad"))
    mean = float(seen["bad"] or 0) / float(seen["n"] or 1)

    def posterior(groups: DataFrame) -> tuple[DataFrame, float]:
        kappa = prior_weight(groups)
        return groups.withColumn("mean", (F.col("bad") + kappa * F.col("prior")) / (F.col("n") + kappa)), kappa

    sums = F.sum("n").alias("n"), F.sum("bad").alias("bad")
    suffix, _ = posterior(counts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(mean)))
    domain, _ = posterior(
        counts.groupBy("domain", "suffix").agg(*sums).join(suffix.select("suffix", F.col("mean").alias("prior")), "suffix")
    )
    of_domain = domain.select("domain", F.col("mean").alias("prior"))
    _, kappa = posterior(counts.select("host", "domain", "n", "bad").join(of_domain, "domain"))
    found = (
        with_levels(hosts.select("host"), suffixes)
        .join(counts.select("host", "n", "bad"), "host", "left")
        .join(domain.select("domain", F.col("mean").alias("_of_domain")), "domain", "left")
        .join(suffix.select("suffix", F.col("mean").alias("_of_suffix")), "suffix", "left")
    )
    prior = F.coalesce("_of_domain", "_of_suffix", F.lit(mean))
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    alpha, beta = bad + kappa * prior, n - bad + kappa * (1 - prior)
    return found.select("host", n.alias("n"), bad.alias("bad"), alpha.alias("alpha"), beta.alias("beta"), (alpha / (alpha + beta)).alias("mean"))


def lower_bound(z: float) -> Column:
    """Posterior mean less ``z`` standard deviations of the beta distribution."""
    total = F.col("alpha") + F.col("beta")
    return F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, max_bad: float = 0.3, z: float = 1.645, id: str = "page_id", url: str = "url", suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(id, host, path, rule, verdict, bad_low) of every page.

    ``outcomes`` are (id, bad); ``rules`` are (rule, verdict), the rule being host and path
    prefix. Rules meet hosts by an equi-join on the host's suffixes, so a list of any length
    will do; pages meet their host's reputation and rules in one join.
    """
    host, path = host_and_path(url)
    pages = pages.select(F.col(id).alias("_id"), host.alias("host"), path.alias("path"))
    marks = outcomes.select(F.col(id).alias("_id"), "bad").join(pages.select("_id", "host"), "_id").select("host", "bad")
    hosts = pages.select("host").distinct()
    standing = reputation(marks, hosts, suffixes).select("host", F.round(lower_bound(z), 9).alias("bad_low"))

    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    ruled = rules.select(F.regexp_extract("rule", "^[^/]*", 0).alias("_tail"), F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("prefix"), "rule", F.col("verdict").alias("said"))
    fitting = (
        hosts.where("host <> ''").select("host", F.explode(tails).alias("_tail"))
        .join(ruled, "_tail")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "prefix", "said")).alias("rules"))
    )
    by_host = standing.join(fitting, "host", "left")
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["prefix"])))
    return (
        pages.join(by_host, "host", "left")
        .withColumn("_best", best)
        .select(
            F.col("_id").alias(id), "host", "path", F.col("_best.rule").alias("rule"),
            F.coalesce("_best.said", F.when(F.col("bad_low") > max_bad, "block").otherwise("allow")).alias("verdict"),
            "bad_low",
        )
    )
