"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(``left``, place): every end of an edge, and the least end that it is connected to. An end is not null.

    In each round a node moves to the least of itself and its neighbours, and from there on to where that one moves. Then the
    edges are drawn between the places reached, and those that lie inside one place, or twice, go. So the graph shrinks, and
    the rounds end when no edge is left. Each round is a written table: a lost executor costs one round. A node with very many
    edges is reduced by partial aggregation, and no table is larger than the given edges.
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
    nodes = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct()
    labels = written(nodes.select("node", F.col("node").alias("label")), "labels")
    rest = written(ends.filter("a <> b").distinct(), "edges")
    while rest.head(1):
        least = (
            rest.select("a", "b").union(rest.select("b", "a")).groupBy("a")
            .agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        )
        least = written(least, "moves")
        onward = least.select(F.col("node").alias("to"), F.col("to").alias("next"))
        moves = written(least.join(onward, "to").select("node", F.least("to", "next").alias("to")), "moves")
        labels = written(
            labels.join(moves.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )
        drawn = rest.join(moves.select(F.col("node").alias("a"), F.col("to").alias("c")), "a")
        drawn = drawn.join(moves.select(F.col("node").alias("b"), F.col("to").alias("d")), "b")
        rest = written(drawn.filter("c <> d").select(F.col("c").alias("a"), F.col("d").alias("b")).distinct(), "edges")
    return labels.select(F.col("node").alias(left), F.col("label").alias("place"))
