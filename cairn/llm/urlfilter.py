"""URL rules by hashed expressions.

A url is expanded into expressions: every suffix of its host at a dot, joined
with those prefixes of its path that are as long as some rule's path. The
expressions meet the rules in an equi-join on a short prefix of their SHA-256;
the full digest confirms a hit, and the longest rule (host and path together,
then the longer host) decides. Without a rule the verdict is ``default``.

A rule fits its host and all subdomains if the url's path starts with the
rule's path. Rules are a frame (host, path, verdict); Spark broadcasts it while
it is small and shuffles it else, so a list of any size works. A host that
fills a third of all rows is no hot key: the rows of one url are reduced where
they were expanded, and urls are dealt by row number.

Defined results: null urls, and urls without ``://``, have an empty host and an
empty path and fit no rule (a rule's host is never empty). Only A-Z of a host
is lower-cased; ports and user names stay part of the host. An empty table
gives an empty result. Rules that repeat host and path: ``block`` wins. Every
row gives one row, repeated rows included; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The rules of the query (host, path, verdict).
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Hex digits of a digest that the join compares (32 bits).
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def url_parts(url):
    """(host, path) columns of a url column."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def digest(text):
    return F.sha2(text.cast("binary"), 256)


def expressions(host, path, path_lengths):
    """Array of host suffix + newline + path prefix."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(path_lengths, lambda n: n <= F.length(path)),
        lambda n: F.substring(path, F.lit(1), n),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, F.lit("\n"), p))))


def judge(urls: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, host, path, rule and verdict of every row of ``urls``."""
    # distinct path lengths of the rules; one small row, joined to every url
    known = rules.where(F.col("host") != "").select(
        F.concat("host", F.lit("\n"), "path").alias("expr"),
        F.concat("host", "path").alias("rule_text"),
        F.length("host").alias("host_len"),
        (F.length("host") + F.length("path")).alias("rule_len"),
        F.length("path").alias("path_len"),
        F.col("verdict").alias("rule_verdict"),
    )
    lengths = sorted(r[0] for r in known.select("path_len").distinct().collect())
    full = known.groupBy("expr", "rule_text", "host_len", "rule_len").agg(
        F.max("rule_verdict").alias("rule_verdict")  # "block" > "allow"
    ).withColumn("full_hash", digest(F.col("expr"))).withColumn("short_hash", F.substring("full_hash", 1, SHORT)).drop("expr")

    host, path = url_parts(F.col(url))
    base = urls.select(F.col(key).alias("key_"), host.alias("host"), path.alias("path")).withColumn("row_", F.monotonically_increasing_id())
    wanted = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    hashed = F.transform(expressions(F.col("host"), F.col("path"), wanted), digest)
    spread = base.withColumn("full", F.explode_outer(hashed))
    # a row with an expression that meets a rule's short prefix keeps it if the full digests agree
    hits = spread.join(full, F.substring("full", 1, SHORT) == F.col("short_hash"), "left").withColumn(
        "hit",
        F.when(F.col("full") == F.col("full_hash"), F.struct("rule_len", "host_len", "rule_text", "rule_verdict")),
    )
    best = hits.groupBy("row_").agg(
        F.first("key_").alias("key_"), F.first("host").alias("host"), F.first("path").alias("path"), F.max("hit").alias("hit")
    )
    return best.select(
        F.col("key_").alias(key),
        "host",
        "path",
        F.col("hit.rule_text").alias("rule"),
        F.coalesce(F.col("hit.rule_verdict"), F.lit(default)).alias("verdict"),
    )
