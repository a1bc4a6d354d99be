"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """From rows (u, v): node, label, the label being the smallest node that can be reached.

    Alternates large-star and small-star steps (MapReduce connected components): every step links nodes to the
    smallest neighbour, so the number of rounds is logarithmic and the number of edges never grows. Neighbour
    lists are never gathered: the smallest neighbour is an aggregate that is joined back. Null nodes and
    self-loops are left out; an empty table gives an empty table.
    """
    now = checkpoint(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if mark == seen:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = checkpoint(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        now = checkpoint(
            linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        )
    # converged: every edge goes from a node to the smallest node of its component
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
