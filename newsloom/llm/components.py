"""Connected components by alternating large and small stars, on tables.

Minima are combinable sums, so a node with very many edges is aggregated before the shuffle; the
joins back read stored tables on both sides, so that adaptive execution can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.frames import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step. pairs: u, v."""
    if large:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(stored(least, "star"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = stored(down.groupBy("u").agg(F.min("v").alias("m")), "star")
        moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def connected_components(pairs: DataFrame) -> DataFrame:
    """pairs: u, v (long). Returns node, component (its smallest node) for all nodes with an edge."""
    now = stored(pairs.select("u", "v").where("u != v").distinct(), "edges")
    mark = None
    while True:
        now = stored(_star(now, True), "edges")
        now = stored(_star(now, False), "edges")
        here = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if here == mark or not here[0]:
            break
        mark = here
    # All edges now run from a node to the smallest of its component.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
