"""URL filter: host-suffix and path-prefix expressions joined to rules by short hash prefixes.

Built-in functions only. Every address becomes a few expressions such as
``example.com/en/``: host suffixes with as many labels as some rule has, times
path prefixes as long as some rule path. An equi-join on the first hex digits
of their SHA-256 finds candidates; full digest and text confirm them. The
longest rule wins; at equal length ``block`` wins.

Defined results: a null address, or one without ``://``, has empty host and
path and gets the default verdict; repeated addresses get the same verdict;
empty tables of pages or rules give no rows or only defaults; a path matches a
rule path as plain text prefix. Columns of the input that clash with the added
names are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def prepared(rules: DataFrame, digits: int) -> DataFrame:
    """(verdict, rule) rows, null-free and one per rule text, with host, path and digests."""
    slash = F.locate("/", "rule")
    return (
        rules.select("verdict", "rule")
        .where("rule is not null and verdict is not null")
        .groupBy("rule")
        .agg(F.max("verdict").alias("rule_verdict"))
        .select(
            "rule",
            "rule_verdict",
            F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1))
            .otherwise(F.col("rule"))
            .alias("rule_host"),
            F.when(slash > 0, F.substring("rule", slash, F.length("rule")))
            .otherwise(F.lit(""))
            .alias("rule_path"),
            F.sha2("rule", 256).alias("rule_digest"),
            F.substring(F.sha2("rule", 256), 1, digits).alias("short"),
        )
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    digits: int = 8,
) -> DataFrame:
    """All rows of ``pages`` with host, path, rule and verdict.

    ``rules`` has columns verdict (``allow`` or ``block``) and rule
    (``host/path``). The numbers of labels and path lengths that occur in rules
    are read first: at most as many values as the longest host or path has.
    """
    rules = prepared(rules, digits)
    shape = rules.agg(
        F.collect_set(F.size(_labels(F.col("rule_host")))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    host, path = split_url(F.col(url))
    kept = [c for c in pages.columns if c not in ADDED]
    split = pages.select(*kept, host.alias("host"), path.alias("path"))
    sites = split.select("host", "path").where("host <> ''").distinct()
    labels = _labels(F.col("host"))
    suffixes = [
        F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), "."))
        for n in sorted(shape["labels"])
    ]
    prefixes = [
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])
    ]
    expressions = (
        sites.withColumn("suffix", F.explode(F.array_compact(F.array(F.lit(None).cast("string"), *suffixes))))
        .withColumn("prefix", F.explode(F.array_compact(F.array(F.lit(None).cast("string"), *prefixes))))
        .withColumn("digest", F.sha2(F.concat("suffix", "prefix"), 256))
        .withColumn("short", F.substring("digest", 1, digits))
    )
    confirmed = expressions.join(rules, "short").where(
        (F.col("digest") == F.col("rule_digest"))
        & (F.col("suffix") == F.col("rule_host"))
        & (F.col("prefix") == F.col("rule_path"))
    )
    best = confirmed.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule_verdict", "rule")).alias("best")
    )
    return split.join(best, ["host", "path"], "left").select(
        *kept,
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
