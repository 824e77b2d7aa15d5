"""URL filters by hashed expressions.

Each URL expands into the (host suffix, path prefix) expressions that some rule could have:
suffixes by the label counts of the rules' hosts, prefixes by the lengths of their paths. The
expressions meet the rules by an equi-join on four bytes of SHA-256; then the full digests
must agree and the longest rule wins.

Defined results: a null URL or one without ``://`` has an empty host and path and gets the
method's verdict; a repeated row is judged like the first and kept; no rule at all leaves
every row its default verdict; further columns of the pages are ignored. Of rules of equal
length the one with the longer host wins, then ``block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.llm.common import ascii_lower, named

RULE_SCHEMA = "array<struct<rule_host:string,rule_path:string,rule_verdict:string>>"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict) as a frame."""
    rows = [F.struct(*(F.lit(v).alias(n) for v, n in zip(r, ("rule_host", "rule_path", "rule_verdict")))) for r in rules]
    listed = F.array(*rows) if rows else F.lit(None).cast(RULE_SCHEMA)
    return spark.range(1).select(F.inline(listed.cast(RULE_SCHEMA)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",),
               default: str = "allow") -> DataFrame:
    """One row per page: ``keep``, host, path, rule (``host + path`` or null) and verdict.

    ``rules`` has rule_host, rule_path and rule_verdict. The label counts and path lengths
    that occur among them are gathered first; there are as many as a host has labels and a
    path has characters, however many rules there are. Spark broadcasts the rules only below
    its own size limit; beyond it the expressions are shuffled, and a hot expression is split
    by the adaptive skew join. What leaves a task is one row per page.
    """
    ready = rules.select(
        ascii_lower(F.col("rule_host")).alias("rule_host"), F.coalesce("rule_path", F.lit("")).alias("rule_path"), "rule_verdict"
    ).where("rule_host is not null")
    shapes = ready.agg(
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    labels = F.array(*map(F.lit, shapes["labels"])).cast("array<int>")
    lengths = F.array(*map(F.lit, shapes["lengths"])).cast("array<int>")

    names = [f"_keep_{i}" for i in range(len(keep))]
    rows = pages.select(
        *(named(c).alias(n) for n, c in zip(names, keep)), url_host(named(url)).alias("host"), url_path(named(url)).alias("path"),
        F.monotonically_increasing_id().alias("_row"),
    )
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(labels, lambda k: k <= F.size(parts)), lambda k: F.array_join(F.slice(parts, -k, k), ".")
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    pairs = F.flatten(
        F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.sha2(F.concat(h, F.lit("\n"), p), 256)))
    )
    expanded = rows.select("*", F.explode_outer(pairs).alias("_digest"))
    hashed = ready.withColumn("_rule_digest", _digest(F.col("rule_host"), F.col("rule_path"))).select(
        "*", F.substring("_rule_digest", 1, 8).alias("_short")
    )
    met = expanded.withColumn("_short", F.substring("_digest", 1, 8)).join(hashed, "_short", "left")
    rank = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("rule_verdict") == "block").cast("int").alias("blocks"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = F.max(F.when(F.col("_digest") == F.col("_rule_digest"), rank)).alias("_best")
    return met.groupBy("_row", *names, "host", "path").agg(best).select(
        *(F.col(n).alias(c) for n, c in zip(names, keep)), "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict")
    )
