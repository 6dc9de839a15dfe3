"""URL verdicts: rules first, else an empirical-Bayes reputation of the host. Only
DataFrame functions; no Python runs on the executors.

Labelled outcomes (1: a bad page) are counted by host. A beta prior flows down from all
pages to the suffix, to the registered domain and to the host: at each level the parent's
posterior mean is the prior mean, and the prior's weight is estimated from how far the
rates of that level scatter beyond chance. A host is blocked when the lower bound of
its posterior rate exceeds a limit, so few labels block nobody.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import ascii_lower, written

# The rules, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Suffixes of more than one label under which domains are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    dotted = F.concat(F.lit("."), host)
    for decision, of, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = dotted.endswith(f".{of}") & path.startswith(start)
        name = F.when(fits, F.lit(of + start)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def with_levels(df: DataFrame) -> DataFrame:
    """Adds ``domain`` and ``suffix`` to ``host``; user and port are no part of them."""
    bare = F.regexp_replace("host", r"^.*@|:\d*$", "")
    two = F.substring_index(bare, ".", -2)
    suffix = F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))
    labels = F.size(F.split(suffix, r"\.")) + 1
    domain = F.when(labels == 3, F.substring_index(bare, ".", -3)).otherwise(two)
    return df.withColumn("suffix", suffix).withColumn("domain", domain)


def _weight(counts: DataFrame, mean: float) -> float:
    """Prior weight of a level by moments: the more the rates scatter, the lighter."""
    rate = F.col("bad") / F.col("n")
    sums = counts.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("k"),
        F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("scatter"),
    ).first()
    chance = mean * (1 - mean)
    room = (sums.n or 0) - (sums.nn or 0) / (sums.n or 1)
    if room <= 0:
        return 100.0
    between = (sums.scatter - (sums.k - 1) * chance) / room
    if between <= chance / 101:
        return 100.0
    return max(1.0, chance / between - 1)


def reputations(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, posterior_mean, lower) for each of ``hosts(host)``; ``outcomes(host, bad)``
    has a row per labelled page. The lower bound is the mean less 1.645 deviations."""
    known = outcomes.filter("bad IS NOT NULL AND host <> ''")
    counted = with_levels(known.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("bigint")).alias("bad")))
    counted = written(counted, "host-outcomes")
    total = counted.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = (total.bad + 0.5) / (total.n + 1.0) if total.n else 0.0
    by = {level: counted.groupBy(level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")) for level in LEVELS}
    weight = {level: _weight(by[level], mean) for level in LEVELS}
    scored = with_levels(hosts)
    prior = F.lit(mean)
    for level in LEVELS:
        part = by[level].select(level, F.col("n").alias(f"n_{level}"), F.col("bad").alias(f"bad_{level}"))
        scored = scored.join(part, level, "left")
        n, bad = (F.coalesce(F.col(f"{c}_{level}"), F.lit(0)) for c in ("n", "bad"))
        alpha, beta = bad + weight[level] * prior, n - bad + weight[level] * (1 - prior)
        scored = scored.withColumn(f"mean_{level}", alpha / (alpha + beta))
        if level != "host":
            prior = F.col(f"mean_{level}")
    spread = F.sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1)))
    lower = F.greatest(F.lit(0.0), F.col("mean_host") - 1.645 * spread)
    return scored.select("host", F.col("mean_host").alias("posterior_mean"), lower.alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, block_above: float = 0.3, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages(page_id, url)``.

    A NULL url or one without ``://`` has empty host and path; the empty host has no
    reputation of its own and is judged by the rate of all pages. Repeated rows are
    judged alike. ``outcomes(host, bad)`` may be empty: then nothing but rules blocks.

    Counts by host combine inside each task. The last join is on the host: its right
    side has one row per host, and the rows of a host with a third of all pages are
    split by adaptive execution, or not moved at all when that side is small.
    """
    at = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # As a table of known size: broadcast when small, else a join that can be split.
    scores = written(reputations(at.select("host").distinct(), outcomes), "host-scores")
    rule, decided = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("lower") > block_above, F.lit("block")).otherwise(F.lit("allow"))
    return at.join(scores, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, learned).alias("verdict")
    )
