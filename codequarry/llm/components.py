"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codequarry.llm.tables import WorkTables


def components(edges: DataFrame, work: WorkTables, name: str) -> DataFrame:
    """(node, label) for each node of the edges (a, b); a label is one node of the component.

    In every round each node steps to its smallest neighbour, edges follow, and loops
    and repeats go. Nodes are hashes, so their order is random and a round leaves a
    fraction of the nodes: a long chain takes a number of rounds that grows with the
    logarithm of its length, a star one. Steps are aggregated map-side, so a node with
    very many edges is no hot spot.
    """
    graph = work.write(edges.filter("a <> b").select("a", "b").distinct(), f"{name}-0")
    labels, turn = None, 0
    while True:
        both = graph.union(graph.select("b", "a"))
        steps = work.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("up")), f"{name}-steps-{turn}")
        if labels is None:
            labels = work.write(steps.select("node", F.col("up").alias("label")), f"{name}-labels-{turn}")
        else:
            moved = labels.join(steps.select(F.col("node").alias("label"), "up"), "label", "left")
            labels = work.write(moved.select("node", F.coalesce("up", "label").alias("label")), f"{name}-labels-{turn}")
            work.drop(f"{name}-labels-{turn - 1}")
        left = graph.join(steps.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
        right = left.join(steps.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        after = right.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        turn += 1
        graph = work.write(after, f"{name}-{turn}")
        work.drop(f"{name}-{turn - 1}", f"{name}-steps-{turn - 1}")
        if graph.isEmpty():
            work.drop(f"{name}-{turn}")
            return labels
