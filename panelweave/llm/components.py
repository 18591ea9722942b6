"""Connected components by alternating large-star and small-star rounds.

Edges stay distributed; each round is a written table, so no plan grows and a
lost executor costs one round at most.  Minima are aggregated before they are
shuffled.  Where a node's edges meet its minimum they are spread over ``SALTS``
salts, each with its own copy of the minimum, so a node with very many edges is
no single key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, written

SALTS = 16


def _with_minimum(edges: DataFrame, on: str, low: DataFrame) -> DataFrame:
    """``edges`` with m from ``low`` (node, m), null where the node has none."""
    edges = edges.withColumn("salt", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int"))
    low = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("node", F.col(on)).join(low, ["node", "salt"], "left").select("a", "b", "m")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between long ids to (node, component): the smallest id that
    each linked node reaches.  Nodes without links do not appear; loops and
    repeated links are harmless."""
    spark = edges.sparkSession
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        # a > b in every edge: a node's smaller neighbours are the b of its edges
        low = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        # large star: larger neighbours go to the smallest one; a node without a
        # smaller neighbour is that itself
        large = written(_with_minimum(now, "b", low).select("a", F.coalesce("m", "b").alias("b")).distinct(), "large-star")
        low = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        small = _with_minimum(large, "a", low).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()
        new = written(small, "small-star")
        remove(spark, large, now)
        now, before = new, state
        state = _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots).distinct()
