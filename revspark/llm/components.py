"""Distributed connected components by alternating large and small stars.

Each round is two grouped minima joined back to the edges; the edge table is
written to the shared folder after every round.  Nothing but the edge count
and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    hang = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hang.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc",
                         a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its
    smallest node.  Self-loops and repeated edges are harmless; an edge with a
    null end is ignored; no edges give no rows.  The alternation converges in
    a number of rounds logarithmic in the number of nodes."""
    e = scratch.save(edges.where(F.col(a) != F.col(b))
                     .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), f"{name}-0")
    sums = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))]
    seen, i = e.agg(*sums).first(), 0
    while seen[0]:
        i += 1
        e = scratch.save(_small_star(_large_star(e)), f"{name}-{i}")
        scratch.drop(f"{name}-{i - 1}")
        last, seen = seen, e.agg(*sums).first()
        if last == seen:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
