"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) of every linked node; root is the component's smallest node.

    Alternates two steps until nothing moves: every node points its larger neighbours, then
    its smaller ones, to the smallest node it knows. Both are an aggregate and a join, so no
    task holds the neighbours of a node and a node with very many is split like any skewed
    join. Each round is written down; the rounds grow with the logarithm of the size.
    Links with a null end or from a node to itself link nothing.
    """
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stored(edges.distinct(), "links")
    before = _checksum(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.filter("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
