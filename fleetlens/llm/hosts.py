"""URL filters: rules first, else the empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, registered domain and public suffix. Each level's rate of bad pages is
shrunk towards the level above by a beta prior whose strength is fitted to the spread among that level's siblings (method of
moments), so a host with few labels speaks with its domain's voice, and a domain with few labels with its suffix's. A
page is blocked if the lower posterior bound of its host's rate of bad pages is above a threshold.

Defined results: a NULL url or one without ``://`` has an empty host and path, matches no rule and is judged by the prior
of all pages; hosts without labels get the posterior of the nearest level that has any; without any labels nothing is
blocked; repeated rows are judged alike; extra columns are kept, columns named as results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize

# Two-label suffixes under which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
                      "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")

LEVELS = ("host", "domain", "suffix")
# The strength of a prior is kept between these numbers of pages.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty where there is none."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (verdict, host, path) that fits; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, of_host, of_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        rule, verdict = F.when(fits, F.lit(of_host + of_path)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def with_levels(df: DataFrame, host: str = "host") -> DataFrame:
    h = F.col(host)
    return df.withColumns({"domain": domain_of(h), "suffix": suffix_of(h)})


def _strength(m: Column) -> Column:
    """Aggregate: the strength of the prior of mean ``m`` around which the rates ``k / n`` of the rows spread.

    By n-weighted moments: between-children variance = observed - binomial, strength = m (1 - m) / variance - 1.
    """
    n = F.col("n")
    seen, chance = F.sum(n * F.pow(F.col("k") / n - m, 2)), F.sum(m * (1 - m))
    free, mean = F.sum(n - 1), F.max(m)
    between = F.when(free > 0, F.greatest(seen - chance, F.lit(0.0)) / free)
    strength = F.when(between > 0, mean * (1 - mean) / between - 1).otherwise(F.lit(MOST_STRENGTH))
    return F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))


def _posterior(key: str, mean: Column, strength: Column) -> list[Column]:
    total = F.col("n") + strength
    return [F.col(key), ((F.col("k") + strength * mean) / total).alias("mean"), total.alias("weight")]


def _shrunk(children: DataFrame, parents: DataFrame, key: str, parent: str) -> DataFrame:
    """Posterior of each child under a beta prior around its parent's mean.

    ``children``: (key, parent, n, k); ``parents``: (parent, mean, ...).
    """
    at = children.join(parents.select(parent, F.col("mean").alias("_mean")), parent)
    strengths = at.groupBy(parent).agg(_strength(F.col("_mean")).alias("_strength"))
    return at.join(strengths, parent).select(*_posterior(key, F.col("_mean"), F.col("_strength")))


def reputations(outcomes: DataFrame, host: str = "host", bad: str = "bad") -> tuple[dict[str, DataFrame], tuple[float, float]]:
    """Posterior (mean, weight) of the rate of bad pages per host, domain and suffix, and over all pages.

    ``outcomes``: a row per labelled page; ``bad`` 0, 1 or NULL (no label). A host with very many pages is pre-aggregated
    before it is shuffled. Every level is written once and read by the next.
    """
    labelled = outcomes.where(F.col(bad).isNotNull() & (F.col(host) != ""))
    hosts = labelled.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(bad).cast("double")).alias("k"))
    hosts = materialize(with_levels(hosts), "hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "suffixes")
    # Two numbers. Half a page of either outcome keeps the overall rate inside (0, 1).
    n, k = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0.0)), F.coalesce(F.sum("k"), F.lit(0.0))).first()
    overall = ((k + 0.5) / (n + 1), n + 1)
    mean = F.lit(overall[0])
    strength = suffixes.agg(_strength(mean)).first()[0]
    by_suffix = materialize(suffixes.select(*_posterior("suffix", mean, F.lit(strength))), "suffix-rates")
    by_domain = materialize(_shrunk(domains, by_suffix, "domain", "suffix"), "domain-rates")
    by_host = materialize(_shrunk(hosts, by_domain, "host", "domain"), "host-rates")
    return {"host": by_host, "domain": by_domain, "suffix": by_suffix}, overall


def lower_bound(mean: Column, weight: Column, z: float) -> Column:
    """Lower bound of a beta posterior by its mean and standard deviation."""
    return F.greatest(mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (weight + 1)), F.lit(0.0))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url",
    most_bad: float = 0.5, z: float = 1.645,
) -> DataFrame:
    """Add host, path, rule, verdict, and the posterior ``bad_rate`` and ``bad_rate_low`` of the host.

    ``outcomes``: (url, bad) of labelled pages.
    """
    levels, (mean, weight) = reputations(outcomes.select(host_of(F.col(url)).alias("host"), "bad"))
    named = ["host", "path", "rule", "verdict", "bad_rate", "bad_rate_low"]
    rows = pages.drop(*[c for c in named if c != url]).withColumns({"__llm_host": host_of(F.col(url)), "__llm_path": path_of(F.col(url))})
    # A row per host, not per page, meets the reputations.
    hosts = rows.select("__llm_host").distinct().withColumns(
        {"__llm_domain": domain_of(F.col("__llm_host")), "__llm_suffix": suffix_of(F.col("__llm_host"))})
    for level in LEVELS:
        side = levels[level].select(
            F.col(level).alias(f"__llm_{level}"), F.struct("mean", "weight").alias(f"_at_{level}"))
        hosts = hosts.join(side, f"__llm_{level}", "left")
    best = F.coalesce("_at_host", "_at_domain", "_at_suffix", F.struct(F.lit(mean).alias("mean"), F.lit(weight).alias("weight")))
    judged = hosts.select("__llm_host", best.alias("_best")).select(
        "__llm_host", F.col("_best.mean").alias("bad_rate"), lower_bound(F.col("_best.mean"), F.col("_best.weight"), z).alias("bad_rate_low"))
    rule, decision = longest_rule(F.col("__llm_host"), F.col("__llm_path"), rules)
    method = F.when(F.col("bad_rate_low") > most_bad, F.lit("block")).otherwise(F.lit("allow"))
    kept = [c for c in pages.columns if c not in named or c == url]
    return rows.join(judged, "__llm_host", "left").select(
        *kept, F.col("__llm_host").alias("host"), F.col("__llm_path").alias("path"), rule.alias("rule"),
        F.coalesce(decision, method).alias("verdict"), "bad_rate", "bad_rate_low")
