"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (C.salted_join(both.where("v > u"), least, ["u"], F.col("v"))
            .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them. Edges point
    from the larger node a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = C.salted_join(edges, least, ["a"], F.col("b")).select("m", F.explode(F.array("a", "b")).alias("x"))
    return tied.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, root the smallest node it reaches; roots
    themselves are left out. ``edges`` has columns a and b. Each round is written to the
    shared folder; the number of rounds grows with the logarithm of the longest chain. Nodes
    with many edges are summed before the shuffle and salted in the joins."""
    now = C.materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    before, state = None, _state(now)
    while state != before and state[0]:
        now = C.materialise(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
