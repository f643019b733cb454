"""Connected components over a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import checkpointed


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's greater neighbours (large), or its lesser ones and itself (small), on its least neighbour.

    edges hold (a, b) with a > b. Least neighbours are aggregated before they move; the join back is one that
    Spark splits where a node has very many neighbours.
    """
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = hung.unionAll(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of the component of each node that has a link; links are pairs (a, b) of longs.

    Every round is checkpointed in the shared folder and only a count and a checksum reach the driver.
    """
    edges = checkpointed(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if state.n == 0 or before == (state.n, state.x):
            break
        before = (state.n, state.x)
        edges = checkpointed(_stars(_stars(edges, True), False))
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(own)
