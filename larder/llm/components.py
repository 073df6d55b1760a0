"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import settled


def _star(sym: DataFrame, large: bool) -> DataFrame:
    """Edges to the least neighbour: from larger neighbours of a node (large), or from it and its smaller ones (small)."""
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = sym.join(least, "u")
    if large:
        return met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return met.filter("v <= u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of its component, for every node of the edges (a, b).

    Each round is written to the shared folder; rounds stop when the edges stay as they are. A hub's edges
    are reduced before they are shuffled, and its join is one that AQE can split.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, before = settled(now, "edges"), None
    while True:
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == before or not seen[0]:
            break
        before = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        down = _star(both, True).filter("u <> v").distinct()
        now = settled(_star(down, False).filter("u <> v").distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
