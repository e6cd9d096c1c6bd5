"""URL filter lists: host-suffix and path-prefix expressions, joined on short hash prefixes.

A URL is expanded into all (host suffix, path prefix) expressions a rule could have. Suffixes are cut
at dots; prefixes have those lengths that occur among the rules, as a rule's path may end anywhere.
An expression is joined with the rules on the first bytes of its digest, a key of fixed small size;
then the whole digests are compared, which settles shared prefixes, and the longest rule wins.
Everything is DataFrame functions.

Each different (host, path) is judged once and the verdict joined back, so a URL that fills a third of
the table costs as much as one. Rules are counted and broadcast only up to a bound, else shuffled.

Null URLs and URLs without ``://`` have an empty host and path, which no rule fits. Of two fitting rules
of equal length the one with the longer host wins; of two rules with the same host and path, a block.
Rows with equal or null ids keep their own verdicts. Columns of ``pages`` with the names of added columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..runtime import broadcast_if_small

# Hex digits of the join key: four bytes of the digest.
PREFIX_DIGITS = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + 1)
    path = F.when(tail.startswith("/"), F.regexp_extract(tail, r"^[^?#]*", 0)).otherwise("")
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rules_frame(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Rules like ``("block", "example.com/de/")`` as a table of verdict, host and path; a rule without slash has an empty path."""
    rows = [(verdict, rule.split("/", 1)[0], rule[len(rule.split("/", 1)[0]) :]) for verdict, rule in rules]
    return spark.createDataFrame(rows, "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
    host, path = url_parts(F.col(f"`{url_col}`"))
    columns = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    keyed = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), host.alias("host"), path.alias("path"))

    rules = rules.select("verdict", F.lower("host").alias("rule_host"), F.col("path").alias("rule_path")).where("rule_host <> ''")
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    rules = rules.select("*", digest.alias("rule_digest"), F.substring(digest, 1, PREFIX_DIGITS).alias("key"))
    # the different lengths of rule paths, at most as many as a path has characters
    lengths = F.array(*[F.lit(r["n"]) for r in rules.select(F.length("rule_path").alias("n")).distinct().collect()]).cast("array<int>")

    urls = keyed.groupBy("host", "path").agg(F.lit(1).alias("one")).drop("one").where("host <> ''")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    ends = F.filter(lengths, lambda n: n <= F.length("path"))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(ends, lambda n: F.sha2(F.concat(h, F.lit("\n"), F.substring(F.col("path"), F.lit(1), n)), 256))))
    expanded = urls.select("host", "path", F.explode(expressions).alias("digest"))
    expanded = expanded.select("*", F.substring("digest", 1, PREFIX_DIGITS).alias("key"))

    hits = expanded.join(broadcast_if_small(rules, rules.count()), "key").where("digest = rule_digest")
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), rule.alias("rule"), F.col("verdict").alias("verdict"))).alias("best")
    judged = hits.groupBy("host", "path").agg(best)
    out = keyed.join(judged, ["host", "path"], "left")
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
