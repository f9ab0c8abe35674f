"""Connected components of a link table, by alternating large and small stars (public: Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut


def _smallest(both: DataFrame) -> DataFrame:
    """The smallest neighbour of each node. Written first: a join of two plain inputs can be split where a node is hot."""
    return cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "smallest")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node in ``links`` (two integer columns); component is the smallest node reached.

    Links of a node with itself and repeated links change nothing. An empty table gives an empty one.
    """
    one, two = links.columns
    pairs = links.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b"))
    edges = cut(pairs.where("a is not null and b is not null and a <> b").distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")).toDF("a", "b"))
        large = both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = cut(large.where("a <> b").distinct(), "large")
        low = _smallest(large)
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = cut(small.union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small")
        if (now := _state(edges)) == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
