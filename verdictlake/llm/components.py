"""Connected components by alternating large-star and small-star steps (Kiveris
et al. 2014). Every step is a partial aggregate and a join on the node with one
row per node, so a hub's edges may lie in any number of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import written


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (a, b) with a > b; large: tie bigger neighbours to the least one
    around, small: tie the node and its smaller neighbours to it."""
    if small:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    tied = around.join(least, "a")
    if small:
        out = tied.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
    else:
        out = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node it is
    connected with. Each round is written to the shared folder; rounds grow with
    the logarithm of the longest chain and end when nothing changes."""
    flat = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = written(flat, purpose)
    mark = None
    while True:
        seen = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        state = written(_star(_star(state, False), True), purpose)
    nodes = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
