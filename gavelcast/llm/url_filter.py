"""Allow and block rules on URLs, found by hashed host-suffix and path-prefix expressions.

A rule ``example.org/es/`` is a host and the beginning of a path. It fits a URL whose host is
that host or one below it and whose path starts with the rule's. The URL is expanded into
every host suffix at a dot, each with the path prefixes of the lengths that rules have. An
expression is looked up by the first 32 bits of its SHA-256; the whole digest confirms a hit,
and of the rules that fit, the longest decides (allow before block between rules of the same string).

Only distinct (host, path) pairs are expanded, so a page or host that fills a third of the
table costs one expansion per distinct path. The rules are broadcast up to ``broadcast_rules``
of them, which is counted first, and shuffled beyond that.

Defined cases: a null URL or one without ``://`` has host and path "". No rule has an empty host,
so it gets the default verdict. Repeated rows are judged each; null rules are skipped. Result columns
replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import c

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8
BROADCAST_RULES = 200_000


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """``(verdict, rule)`` of pairs like ``("block", "example.org/es/")``."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def expressions(host: str, path: str, lengths: list[int]) -> Column:
    """All host suffixes of column ``host``, each with the prefixes of ``path`` of the given lengths."""
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths])
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(prefixes, lambda p: p.isNotNull()), lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
          broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``."""
    known = (
        rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull())
        .groupBy(F.concat(F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER),
                          F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")).alias("rule"))
        .agg(F.min("verdict").alias("rule_verdict"))
        .where(~F.col("rule").startswith("/") & (F.col("rule") != ""))
        .withColumn("digest", _digest(F.col("rule")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    sizes = known.groupBy(
        (F.length("rule") - F.length(F.substring_index("rule", "/", 1))).alias("path_length")).count().collect()
    lengths = sorted(row["path_length"] for row in sizes) or [0]
    if sum(row["count"] for row in sizes) <= broadcast_rules:
        known = F.broadcast(known)

    kept = [name for name in pages.columns if name not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[c(name) for name in kept], host_of(c(url)).alias("host"), path_of(c(url)).alias("path"))
    looked_up = (
        rows.select("host", "path").distinct()
        .select("host", "path", F.explode(expressions("host", "path", lengths)).alias("expression"))
        .withColumn("_digest", _digest(F.col("expression")))
        .withColumn("prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    )
    best = (
        looked_up.join(known, "prefix").where(F.col("digest") == F.col("_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("rule_verdict"))).alias("best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        *[c(name) for name in kept], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"))
