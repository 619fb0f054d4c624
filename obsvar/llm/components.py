"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.session import materialise


def _rank(node: str) -> Column:
    return F.struct(F.xxhash64(node).alias("hash"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is one of the component's nodes.

    In each round every node moves to the neighbour of the smallest hash, if that is smaller than
    its own, and on to where that one moves; edges follow their ends, and edges within a node
    vanish. By hash, chains and stars shrink by a constant part in each round. Neighbours are only
    ever reduced to their minimum, so a node that owns most edges is no group in memory. Edges and
    labels are cut from their lineage by reliable checkpoints.
    """
    edges = materialise(edges.select("a", "b").filter("a <> b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank("b")).alias("best")).withColumn("best", F.least("best", _rank("a")))
        moves = best.select(F.col("a").alias("node"), F.col("best")["node"].alias("to"))
        onward = moves.select(F.col("node").alias("to"), F.col("to").alias("then"))
        moves = materialise(moves.join(onward, "to").select("node", F.col("then").alias("to")))
        if labels is None:
            labels = moves.select("node", F.col("to").alias("label"))
        else:
            to = moves.select(F.col("node").alias("label"), "to")
            labels = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
            labels = materialise(labels)
        for end in ("a", "b"):
            edges = edges.join(moves.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        edges = materialise(edges.select("a", "b").filter("a <> b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
