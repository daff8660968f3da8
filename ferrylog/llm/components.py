"""Connected components by contraction, with stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is its component's least node.

    Each round every node joins its least neighbour and edges move to what their
    ends joined, so at least half of the nodes that still have edges go. Least
    neighbours are combined before the shuffle: a node may have any number of edges.
    """
    edges = written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(
            "a != b"
        ).distinct(),
        "edges",
    )
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = ends.select("node", F.col("node").alias("root"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("from")).agg(F.min("b").alias("to"))
        step = written(least.select("from", F.least("from", "to").alias("to")), "step")
        moved = roots.join(step, F.col("root") == F.col("from"), "left")
        roots = written(moved.select("node", F.coalesce("to", "root").alias("root")), "roots")
        left = edges.join(step, F.col("a") == F.col("from")).select(F.col("to").alias("a"), "b")
        right = left.join(step, F.col("b") == F.col("from")).select("a", F.col("to").alias("b"))
        kept = right.filter("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        edges = written(kept.distinct(), "edges")
    return roots
