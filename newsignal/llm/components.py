"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsignal.llm import common


def least_neighbour(edges: DataFrame, upward: bool) -> DataFrame:
    """Links nodes to the least node next to them.

    ``upward``: each node hands its least neighbour (or itself) to its larger neighbours;
    otherwise to itself and its smaller ones.  Minima are combined before the shuffle and
    joined back, so a node with very many neighbours is split by Spark.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = both if upward else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # Written, so that the join has plain exchanges and Spark can split a node's many edges.
    least = common.written(
        pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
        "least",
    )
    if upward:
        linked = pairs.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the edges (a, b) can reach.

    Alternates the two steps until every node links to its component's least node.  Each
    round is written to the shared folder; the driver sees a count and a checksum only.
    Nodes must not be null.
    """
    edges = common.written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        edges = common.written(least_neighbour(least_neighbour(edges, True), False), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
