"""Connected components by alternating large-star and small-star steps.

Each step hangs a node's neighbours on their least one. Links are kept as
(larger, smaller) pairs and written to the shared scratch folder after each
round; only a count and a checksum reach the driver. A node with very many
links costs one partial minimum and one row per link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.scratch import kept, removed


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Per node u with its neighbours (all of them, or the smaller ones): links
    from each larger (or every) neighbour to the least of them and u."""
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        sides = sides.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    if both_ways:
        out = sides.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
    else:
        out = (sides.join(least, "u").filter("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node that has a link; ``links`` has the
    columns a and b. A component is named by its least node."""
    spark = links.sparkSession
    links = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = kept(links, name)
    mark = None
    while True:
        new_mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if new_mark == mark or not new_mark[0]:
            break
        mark = new_mark
        following = kept(_star(_star(state, True), False), name)
        removed(spark, state)
        state = following
    return (state.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
