"""Connected components of links, by repeated star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macroloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the links: two numbers."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b): the least id that links lead to.

    Large-star and small-star in turn: every id tells its larger neighbours, then its smaller ones,
    the least id it knows of, until nothing changes. A round is two least-value aggregates, which
    combine before the shuffle, and two joins in which AQE splits ids of many links. Each round is
    written, so that lineage does not grow. Nulls, loops and repeated links add nothing.
    """
    edges = stored(links.select("a", "b").where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(met.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a != b").distinct(), "links")
        old, state = state, _state(edges)
        if state == old:
            break
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots.select("id", F.col("id").alias("component")))
