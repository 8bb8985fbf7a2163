"""Connected components of a large graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroflow.llm.common import stored


def _with_least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and all its neighbours.

    The minimum is combined before the shuffle and stored; the join back then has a shuffle of
    its own, which may be split at a hot node, so a node with a third of all edges is no
    single task.
    """
    least = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return edges.join(stored(least, "least"), "u")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges (u, v)``; root is the least node it reaches.

    Each round has a large star (every larger neighbour goes to the least node
    around) and a small star (the same for smaller neighbours). Rounds end when the
    edges no longer change; their number grows with the logarithm of the graph.
    An empty graph has no nodes; loops and repeated edges are ignored.
    """
    plain = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(plain.distinct(), "edges")
    state = None
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _with_least_neighbour(large)
        small = small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        small = small.select("e.u", F.col("e.m").alias("v")).where("u <> v").distinct()
        current = stored(small, "edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
