"""URL filtering by empirical-Bayes host reputation, in DataFrame functions only.

Labelled pages give each host bad and good outcomes. A host's rate is shrunk towards its registered
domain's, that towards its suffix's, and that towards the overall rate, each through a beta prior
whose strength is fitted to how much the groups of that level differ. A host is blocked when the lower
bound of its posterior bad rate is above a threshold: little evidence is not enough to block. Explicit
rules on host and path come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.llm.suffixes import SUFFIXES

#: Lower posterior bound: this many standard deviations below the mean.
Z = 1.645


def address(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: the host up to ``/``, ``?`` or ``#`` with A-Z in lower case, the path up to ``?`` or ``#``.

    Null, or no ``://``: both empty.
    """
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null without one; rules are (verdict, host, path)."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        found = F.coalesce(found, F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    return found


def levels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix): the suffix is the longest end of the host that is in ``suffixes``, else its last
    label; the domain has one label more, or is the suffix itself. An address in digits is its own domain."""
    numeric = host.rlike(r"^[0-9.]+(:[0-9]+)?$")
    name = F.regexp_replace(host, r":[0-9]*$", "")
    domain, suffix = F.substring_index(name, ".", -2), F.substring_index(name, ".", -1)
    for labels in sorted({s.count(".") + 1 for s in suffixes} - {1}):
        end = F.substring_index(name, ".", -labels)
        listed = end.isin([s for s in suffixes if s.count(".") + 1 == labels])
        domain = F.when(listed, F.substring_index(name, ".", -labels - 1)).otherwise(domain)
        suffix = F.when(listed, end).otherwise(suffix)
    return F.when(numeric, host).otherwise(domain), F.when(numeric, F.lit("")).otherwise(suffix)


def _strength(groups: DataFrame) -> float:
    """The prior strength that explains how rates of groups (bad, n) differ around their prior ``mean``.

    Method of moments for a beta-binomial: with rho the part of the variance between groups, the squared
    differences weighted by n add up to sum(v * (1 + rho * (n - 1))), v being mean * (1 - mean), and the
    strength is 1 / rho - 1. Kept between 1 and 1000. One number per level comes to the driver.
    """
    row = groups.select(F.expr("mean * (1 - mean)").alias("v"), "n", F.expr("n * pow(bad / n - mean, 2)").alias("s")).agg(
        F.expr("(sum(s) - sum(v)) / nullif(sum(v * (n - 1)), 0)").alias("rho")
    ).first()
    rho = row["rho"]
    if rho is None:
        return 10.0
    return min(1000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 1000.0


def host_reputation(outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Posteriors of hosts, domains and suffixes from rows (host, bad): bad is 0 or 1, null is ignored.

    Rows (level, name, alpha, beta), one per group, and level ``all`` with the name ``''``. Outcomes are
    counted per host first, so a host with a third of the rows is one row after the map side.
    """
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = (
        outcomes.where("bad is not null")
        .groupBy("host")
        .agg(F.sum("bad").cast("double").alias("bad"), F.count("*").cast("double").alias("n"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    # Jeffreys' prior keeps the overall rate away from 0 and 1.
    overall = hosts.agg(
        (F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5).alias("alpha"),
        (F.coalesce(F.sum(F.expr("n - bad")), F.lit(0.0)) + 0.5).alias("beta"),
    ).select(F.lit("all").alias("level"), F.lit("").alias("name"), "alpha", "beta")
    result, above = overall, overall
    for level, parent in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        # Names of a level determine the parent's name, so the maximum is that name.
        up = F.max(parent) if parent else F.lit("")
        groups = hosts.groupBy(F.col(level).alias("name")).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), up.alias("up"))
        prior = above.select(F.col("name").alias("up"), F.expr("alpha / (alpha + beta)").alias("mean"))
        groups = groups.join(prior, "up")
        above = groups.withColumn("strength", F.lit(_strength(groups))).select(
            F.lit(level).alias("level"),
            "name",
            F.expr("mean * strength + bad").alias("alpha"),
            F.expr("(1 - mean) * strength + n - bad").alias("beta"),
        )
        result = result.unionByName(above)
    return result


def lower_bound(alpha: Column, beta: Column) -> Column:
    total = alpha + beta
    return alpha / total - Z * F.sqrt(alpha * beta / (total * total * (total + 1)))


def judge_urls(
    pages: DataFrame,
    reputation: DataFrame,
    rules: list[tuple[str, str, str]],
    threshold: float = 0.15,
    id_col: str = "page_id",
    url_col: str = "url",
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """One row per page: id, host, path, ``rule`` (null without one), ``verdict`` and ``bad_rate``, the bound.

    Without a rule the verdict is ``block`` when the posterior bound of the nearest known level (host,
    domain, suffix, all) is above ``threshold``. A null or malformed URL has an empty host and path and
    is judged by the overall rate. Repeated rows stay, an empty table gives none, and only the two
    named columns are read. Distinct hosts are judged once and joined back; a hot host is a skewed
    join key, which AQE splits.
    """
    host, path = address(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    domain, suffix = levels(F.col("host"), suffixes)
    names = rows.select("host").distinct().withColumns({"domain": domain, "suffix": suffix, "all": F.lit("")})
    for level in ("host", "domain", "suffix", "all"):
        known = reputation.where(F.col("level") == level).select(
            F.col("name").alias(level), F.struct("alpha", "beta").alias(f"at_{level}")
        )
        names = names.join(known, level, "left")
    best = F.coalesce("at_host", "at_domain", "at_suffix", "at_all")
    bounds = names.withColumn("best", best).select("host", lower_bound(F.col("best.alpha"), F.col("best.beta")).alias("bad_rate"))
    found = rule_for(F.col("host"), F.col("path"), rules)
    return (
        rows.join(bounds, "host")
        .withColumn("found", found)
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            F.col("found.rule").alias("rule"),
            F.coalesce(F.col("found.verdict"), F.when(F.col("bad_rate") > threshold, "block").otherwise("allow")).alias("verdict"),
            "bad_rate",
        )
    )
