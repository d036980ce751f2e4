"""Connected components by alternating large-star and small-star steps.

Each step turns a node's links into links to the smallest neighbour known, until every component
is a star around its smallest node. Minima come from a grouping (combined before the shuffle) and
go back by an equi-join that AQE can split, so a node with a third of all links is no obstacle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import cut


def _state(links: DataFrame) -> tuple:
    """Number and hash of the links; equal before and after a round when nothing moves."""
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"),
        F.bit_xor(F.xxhash64("v", "u")).alias("g")).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is its smallest node.

    Links with a null end or between a node and itself count for nothing; repeats and direction do
    not matter. No links give an empty table. Each round is cut off by a checkpoint.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    star = cut(links.where(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct())
    state = _state(star)
    while state[0]:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        star, before = cut(small), state
        state = _state(star)
        if state == before:
            break
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
