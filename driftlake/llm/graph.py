"""Connected components of a graph whose edges may exceed any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and root (smallest node reachable) of every node, from edges (a long, b long).

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    smallest one, then its smaller neighbours to its smallest one.  Each round is written to the
    shared folder.  Edges are only ever joined with one row per node, never with each other.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, before = stored(edges.distinct(), "edges"), None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least).distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
