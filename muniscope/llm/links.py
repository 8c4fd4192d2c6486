"""Connected components of a link table, by star contraction: no component is ever gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component) for every node that a link names; component is the smallest node reachable.

    Each round joins every node's neighbours to its smallest one, first for larger neighbours, then for smaller ones, until
    nothing changes (a logarithmic number of rounds on long chains). Rounds are settled in the shared folder, and a node's
    many neighbours meet only its smallest one, in a join that can be split.
    """
    edges = settle(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(rounds):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = settle(large, "links")
        small = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(small, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        edges = settle(met.where(F.col("hi") != F.col("lo")).distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)


def _mark(edges: DataFrame):
    """Changes whenever the links change."""
    return edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(hi, lo))")).first()
