"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlift.sources.workspace import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    linked = both.join(least, F.col("a") == F.col("n")).where(F.col("b") > F.col("a"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    linked = down.join(least, F.col("a") == F.col("n"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select(F.col("n").alias("a"), F.col("m").alias("b"))
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, label)``, the label being the component's least node.

    Nodes without a link do not appear. Every round writes its edges to the
    shared folder; the number of rounds grows with the logarithm of the longest
    chain. No component is ever gathered in one place. Links of a node to
    itself and repeated links are harmless, an empty table gives an empty one.
    """
    edges = materialize(edges.select("a", "b").where("a <> b").distinct(), "links")
    mark = _mark(edges)
    while True:
        stars = _small_star(_large_star(edges)).where("a <> b").distinct()
        edges = materialize(stars, "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
