"""Connected components of a link table, by randomised contraction.

In each round every node moves to the neighbour (or itself) that comes first in
an order; links between nodes that met disappear.  The first round goes by the
nodes themselves, which folds stars around their smallest node at once; later
rounds go by a hash that is drawn anew, which shrinks any graph (a long chain
too) by a constant factor.  Only minima are aggregated, which Spark combines
before the shuffle, so the hub of a large star is no burden; nothing but
whether links are left comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (``a``, ``b``: longs, not
    null); the component is its smallest node."""
    edges = shared_table(links.filter(F.col("a") != F.col("b")).distinct(), "links")
    first, turn, moves = edges, 0, []
    while edges.limit(1).count():
        turn += 1

        def place(c):
            return F.struct((c if turn == 1 else F.xxhash64(c, F.lit(turn))).alias("k"), c.alias("n"))

        both = edges.select(F.explode(F.array(F.struct("a", "b"),
                                              F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        goes = (both.groupBy(F.col("e.a").alias("was"))
                .agg(F.min(F.least(place(F.col("e.b")), place(F.col("e.a")))).alias("m"))
                .select("was", F.col("m.n").alias("to")))
        goes = shared_table(goes, "moves")
        moves.append(goes)
        from_a = edges.join(goes, F.col("a") == F.col("was")).select(F.col("to").alias("a"), "b")
        edges = shared_table(from_a.join(goes, F.col("b") == F.col("was")).select("a", F.col("to").alias("b"))
                             .filter(F.col("a") != F.col("b")).distinct(), "links")
    nodes = first.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("at", F.col("node"))
    for goes in moves:
        nodes = nodes.join(goes, F.col("at") == F.col("was"), "left").select("node", F.coalesce("to", "at").alias("at"))
    nodes = shared_table(nodes, "nodes")
    smallest = shared_table(nodes.groupBy("at").agg(F.min("node").alias("component"))
                            .withColumnRenamed("at", "was"), "smallest")
    return nodes.join(smallest, F.col("at") == F.col("was")).select("node", "component")
