"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from graniteloom.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node that links (a, b) join to a smaller one; root is its component's smallest.

    Each round is two aggregations with map-side minima and joins on the node, and is written out;
    links of the next round never exceed this one's. Nodes that are their component's smallest have no row.
    """
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges, told = scratch.counted(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0", mark)
    last, k = None, 0
    while True:
        if told == last or told[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        last = told
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.keep(large, f"{name}-{k}-large")
        least = large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        met = large.join(least, F.col("u") == F.col("c"))
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        k += 1
        edges, told = scratch.counted(small, f"{name}-{k}", mark)
        scratch.drop(f"{name}-{k - 1}", f"{name}-{k - 1}-large")
