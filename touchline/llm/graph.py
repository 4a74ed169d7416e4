"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component's number is its smallest node.

    Each round, every node points its larger neighbours to its smallest
    neighbour, then its smaller ones (Kiveris et al. 2014); the number of
    rounds grows with the logarithm of the longest chain. Minima are combined
    before the shuffle, and the joins have one row per node on one side, so
    adaptive execution can split a node with very many links. Each round is
    written to the shared checkpoint folder. No links give no rows.
    """
    current = cut_lineage(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
    seen = None
    while True:
        both = current.union(current.select("b", "a")).toDF("node", "other")
        low = both.groupBy("node").agg(F.min("other").alias("low")).withColumn("low", F.least("node", "low"))
        large = both.where("other > node").join(low, "node").select(F.col("other").alias("node"), F.col("low").alias("other"))
        down = large.where("node <> other").distinct()
        low = down.groupBy("node").agg(F.min("other").alias("low"))
        rest = down.join(low, "node").where("other <> low").select(F.col("other").alias("a"), F.col("low").alias("b"))
        current = cut_lineage(rest.union(low.select("node", "low")).distinct())
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    edges = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return edges.union(edges.select(F.col("component"), F.col("component"))).distinct()
