"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import stage


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours now hang on the smallest of the node and all its neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("least"))
    return edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def components(edges: DataFrame, label: str = "links") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has longs ``a`` and ``b`` without nulls. Large-star and small-star
    rounds in turn, each written out; the number of rounds grows with the logarithm
    of the number of nodes. Loops and repeated edges do no harm; no edge, no row.
    """
    flat = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    flat = stage(flat, label)
    before = _sign(flat)
    while before[0]:
        both = flat.unionAll(flat.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("least").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e"),
        ).select("e.*").where("a > b").distinct()
        flat = stage(small, label)
        after = _sign(flat)
        if after == before:
            break
        before = after
    return flat.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        flat.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
