"""URL filters by expression hashes.

Each rule is a host and a path prefix.  Each distinct URL is expanded into the
host-suffix and path-prefix expressions that rules could have, expressions meet
rules in an equi-join on the first four bytes of their SHA-256, a match counts
only if the full digests agree, and the longest rule wins.  DataFrame functions
only.

URLs are expanded just for the label counts of hosts and the lengths of paths
that some rule has (two short lists, bounded by the longest rule), so a host of
many labels or a very long path costs no more than the rules ask for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.llm.common import same

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path, verdict) of the contract.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
DEFAULT = "allow"
PREFIX_BYTES = 4
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def rule_rows(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A short list of (host, path, verdict) as a table, made in the JVM."""
    names = ("host", "path", "verdict")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no "/", so host and path can't be confused.
    return F.unhex(F.sha2(F.concat(host, F.when(path.startswith("/"), F.lit("")).otherwise(F.lit("\0")), path), 256))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (host and path of the winning rule, or null)
    and verdict for each row of ``pages`` (page_id, url); ``rules`` has host,
    path, verdict.  A rule fits its host and subdomains if the URL's path
    starts with its path; the longest rule (host and path together) wins, then
    the longer host, then ``block``.  Null URLs and URLs without ``://`` have
    empty host and path and no rule.  Empty tables give no rows.
    """
    r = rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), "verdict")
    r = r.filter("r_host is not null and r_path is not null").withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
    # The label counts and path lengths that rules have together, and no others.
    shape = r.select(F.size(F.split("r_host", r"\.")).alias("labels"), F.length("r_path").alias("length")).distinct().collect()
    shape = sorted((row["labels"], row["length"]) for row in shape)

    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    distinct = urls.select("host", "path").distinct().filter("host != ''")
    parts = F.split("host", r"\.")
    pairs = F.filter(
        F.array(
            *[
                F.when(
                    (F.size(parts) >= n) & (F.length("path") >= m),
                    F.struct(F.substring_index(F.col("host"), ".", -n).alias("suffix"), F.substring("path", 1, m).alias("prefix")),
                )
                for n, m in shape
            ]
        ),
        lambda x: x.isNotNull(),
    )
    expressions = distinct.withColumn("pair", F.explode(pairs)).withColumn("digest", _digest(F.col("pair.suffix"), F.col("pair.prefix")))
    short = lambda c: F.substring(c, 1, PREFIX_BYTES)
    e = expressions.select("host", "path", F.col("digest").alias("e_digest"), short(F.col("digest")).alias("short"))
    hits = e.join(r.withColumn("short", short(F.col("digest"))), "short").filter("e_digest = digest")
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("long"),
        F.length("r_host").alias("host"),
        F.col("verdict").alias("verdict"),
        F.concat("r_host", "r_path").alias("rule"),
    )
    best = hits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    u, b = urls.alias("u"), best.alias("b")
    joined = u.join(b, same(F.col("u.host"), F.col("b.host")) & same(F.col("u.path"), F.col("b.path")), "left")
    return joined.select(
        "page_id", "u.host", "u.path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
