"""Allow and block rules on URLs by expansion and hash-prefix joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hexadecimal digits of a SHA-256 digest that the equi-joins compare before the whole digest is.
PREFIX_DIGITS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """Text from the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _hashed(df: DataFrame, text: Column, name: str) -> DataFrame:
    return df.withColumn(f"{name}_digest", F.sha2(text, 256)).withColumn(f"{name}_short", F.substring(f"{name}_digest", 1, PREFIX_DIGITS))


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains of it
    where the path starts with the rule's path. The longest rule text wins, among equally long
    ones that of the longer host; of the same rule with both verdicts, ``block``.

    Each distinct URL is expanded into the suffixes of its host, which meet the rules' hosts to
    learn which path lengths any rule there has; suffix and path prefix of those lengths meet the
    rules themselves. Both meetings are equi-joins on the first digits of a digest, and the whole
    digest is compared afterwards, so two texts that share the digits cannot be mixed up.

    Nulls, empty texts and URLs without ``://`` have empty host and path and get ``default``.
    Repeated rows and repeated or null ids are judged row by row. Very long hosts are expanded only
    to as many labels as the longest rule has. Other columns of either frame are ignored.
    """
    asked = pages.select(F.col(id_column), url_host(F.col(url_column)).alias("host"), url_path(F.col(url_column)).alias("path"))
    known = (
        rules.select(F.col("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
        .where(F.col("rule_host") != "")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
    )
    depth = known.agg(F.max(F.size(F.split("rule_host", "[.]")))).first()[0]  # one number
    if depth is None:
        return asked.select(id_column, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    shapes = _hashed(known.select("rule_host", F.length("rule_path").alias("taken")).distinct(), F.col("rule_host"), "host").drop("rule_host")
    full = known.withColumn("rule", F.concat("rule_host", "rule_path"))
    full = _hashed(full, F.col("rule"), "rule").select("rule_digest", "rule_short", "rule", F.length("rule_host").alias("host_length"), "verdict")

    distinct = asked.select("host", "path").where(F.col("host") != "").distinct()
    labels = F.expr("length(host) - length(replace(host, '.', '')) + 1")
    suffixes = distinct.withColumn("labels", F.least(labels, F.lit(depth))).select(
        "host", "path", F.explode(F.expr("transform(sequence(1, labels), k -> substring_index(host, '.', -k))")).alias("suffix")
    )
    prefixes = (
        _hashed(suffixes, F.col("suffix"), "own")
        .join(shapes, F.col("own_short") == F.col("host_short"))
        .where((F.col("own_digest") == F.col("host_digest")) & (F.col("taken") <= F.length("path")))
        .select("host", "path", F.concat("suffix", F.expr("substring(path, 1, taken)")).alias("expression"))
    )
    fitting = (
        _hashed(prefixes, F.col("expression"), "own")
        .join(full, F.col("own_short") == F.col("rule_short"))
        .where(F.col("own_digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), "host_length", "verdict", "rule")).alias("best"))
    )
    return asked.join(fitting, ["host", "path"], "left").select(
        id_column, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
