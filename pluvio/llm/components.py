"""Connected components of a distributed edge list.

Alternating large-star and small-star steps.  Edges stay in a table; each
step is a grouped minimum and a join, and its result is written to the shared
folder, so plans stay short and a lost executor costs one step at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import materialise

_MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _mark(e: DataFrame) -> tuple:
    """Count and order-free digest of an edge list."""
    return tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(u, v, 1) as decimal(20, 0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(u, v)``: the label is the
    smallest node of its component.  No edges give no rows; loops count for
    nothing."""
    e = materialise(edges.select("u", "v").filter("u != v").distinct(), "edges")
    before = _mark(e)
    for _ in range(_MAX_ROUNDS):
        e = materialise(_small_star(_large_star(e)), "stars")
        now = _mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    # a fixed point is a star around each component's smallest node
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
