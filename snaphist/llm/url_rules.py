"""Allow and block rules for URLs, found by joining hashed expressions.

A URL stands for the expressions made of each suffix of its host and each prefix of its path. Rules
and expressions meet in an equi-join on four bytes of their digest; the full digest and the rule's
path are then confirmed, and the longest rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaphist.llm.store import MAX_BROADCAST_ROWS, ascii_lower

RULE_SCHEMA = "verdict string, host string, path string"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#``; A-Z lower-cased, else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    """What follows the host, to the next ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def rules(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _keyed_rules(rule_table: DataFrame) -> DataFrame:
    """Rules by digest of host and path up to its last slash; the rest is confirmed later."""
    stem = F.regexp_extract("path", r"(?s)^(.*/)?", 0)
    digest = _digest(F.col("host"), stem)
    return rule_table.where("host is not null and path is not null").select(
        F.col("verdict").alias("_verdict"),
        F.col("host").alias("_rule_host"),
        F.col("path").alias("_rule_path"),
        digest.alias("_rule_digest"),
        _prefix(digest).alias("_rule_key"),
    )


def expressions(urls: DataFrame, max_labels: int, max_slashes: int) -> DataFrame:
    """(url, host, path, _digest, _key) for each host suffix and path prefix a rule could have.

    ``max_labels`` and ``max_slashes`` are the largest numbers among the rules, so nothing is lost.
    """
    labels = F.split("host", r"\.", -1)
    n = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(max_labels))),
        lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."),
    )
    parts = F.split("path", "/", max_slashes + 1)
    slashes = F.size(parts) - 1
    paths = F.transform(
        F.sequence(F.lit(0), slashes),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))
        ),
    )
    return (
        urls.select("url", "host", "path", F.explode(hosts).alias("_h"), paths.alias("_paths"))
        .select("url", "host", "path", "_h", F.explode("_paths").alias("_p"))
        .withColumn("_digest", _digest(F.col("_h"), F.col("_p")))
        .withColumn("_key", _prefix(F.col("_digest")))
        .drop("_h", "_p")
    )


def judge(pages: DataFrame, rule_table: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains of it if the path starts with the rule's path. The longest
    rule (host and path together) wins; among those the longer host, then ``block``. A url that
    is null or has no ``://`` has an empty host and path. Where no rule fits, ``rule`` is null and
    the verdict is ``default``. Equal urls are judged once, whatever their number; each row of
    ``pages`` keeps its place. Columns of ``pages`` named like a result are replaced. A rule
    with a null host or path fits nothing.
    """
    sizes = rule_table.agg(
        F.max(F.size(F.split("host", r"\.", -1))), F.max(F.size(F.split("path", "/", -1)) - 1)
    ).first()
    few = rule_table.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS
    keyed = _keyed_rules(rule_table)
    urls = (
        pages.where("url is not null")
        .select("url")
        .distinct()
        .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    )
    found = expressions(urls, max(1, sizes[0] or 1), max(0, sizes[1] or 0))
    name = F.concat("_rule_host", "_rule_path")
    best = (
        found.join(F.broadcast(keyed) if few else keyed, F.col("_key") == F.col("_rule_key"))
        .where(
            (F.col("_digest") == F.col("_rule_digest"))
            & F.startswith(F.col("path"), F.col("_rule_path"))
        )
        .groupBy(F.col("url").alias("_url"))
        .agg(
            F.max(
                F.struct(
                    F.char_length(name),
                    F.char_length("_rule_host"),
                    (F.col("_verdict") == "block").cast("int"),
                    name.alias("rule"),
                    F.col("_verdict").alias("verdict"),
                )
            ).alias("_best")
        )
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return (
        pages.select(*kept)
        .join(best, F.col("url") == F.col("_url"), "left")
        .select(
            *kept,
            F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
            path_of(F.col("url")).alias("path"),
            F.col("_best.rule").alias("rule"),
            F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
        )
    )
