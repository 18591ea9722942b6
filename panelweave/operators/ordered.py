"""Operators on ordered rows: interpolation, steps, blocks, runs.

Without a key (``by=[]``) the rows are one long order: see ``scans``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import scans


def interpolate(queries: DataFrame, knots: DataFrame, by: list[str], x: str = "x", y: str = "y", out: str = "y", buckets: int | None = None) -> DataFrame:
    """Add ``out``: linear between the knots around ``x``, clamped at the ends.

    Knots of one x are averaged; rows without x or without a curve get null.
    Knots and queries of each curve (``by``, such as the chromosome) go through
    one sorted stream, dealt by ranges, and each query takes the last knot at or
    before it with it: neither long curves nor wide gaps are unfolded.  ``buckets``
    is the number of ranges.
    """
    k = knots.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, F.col(x).cast("double").alias("__x")).agg(F.avg(y).alias("__y0"))
    first = k.groupBy(*by).agg(F.min_by("__y0", "__x").alias("__start"))
    # the knot after each: the one before it in falling order
    turned = scans.previous(k.withColumn("__down", -F.col("__x")), [*by, "__down"], buckets, __x1="__x", __y1="__y0", **{f"__by_{c}": c for c in by})
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__by_{c}"))
    k = turned.select(*by, "__x", "__y0", *(F.when(same, F.col(c)).alias(c) for c in ("__x1", "__y1")))
    asked = queries.withColumns({"__x": F.col(x).cast("double"), "__id": F.monotonically_increasing_id()})
    met = scans.as_of(asked, k, by, "__x", ["__y0", "__x1", "__y1"], "__id", "__knot", buckets)
    # one row a curve; a curve is a chromosome, and more of them shuffle
    met = met.join(first, by, "left") if by else met.join(F.broadcast(first))
    knot = lambda c: F.col(f"__knot.{c}")
    share = (F.col("__x") - knot("__x")) / (knot("__x1") - knot("__x"))
    value = F.when(F.col("__knot").isNull(), F.col("__start")).when(knot("__x1").isNull(), knot("__y0")).otherwise(knot("__y0") + share * (knot("__y1") - knot("__y0")))
    return met.select(*queries.columns, F.when(F.col("__x").isNotNull(), value).alias(out))


def steps(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Add step: the change of ``value`` from the row before, 0 at the first."""
    if not by:
        return scans.steps(df, [order], value)
    return df.withColumn("step", F.coalesce(F.col(value) - F.lag(value).over(W.partitionBy(*by).orderBy(order)), F.lit(0)))


def is_monotone(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """decreases and monotone: whether ``value`` never falls along ``order``."""
    return steps(df, by, order, value).agg(F.count_if(F.col("step") < 0).alias("decreases")).select("decreases", (F.col("decreases") == 0).alias("monotone"))


def blocks(df: DataFrame, by: list[str], order: list[str], size: int) -> DataFrame:
    """Add block: 1-based number of each run of ``size`` rows."""
    if not by:
        return scans.blocks(df, order, size).withColumn("block", F.col("block").cast("int"))
    n = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("block", F.ceil(n / size).cast("int"))


def runs(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """by, value, run, start, size of each maximal run of equal values.

    ``start`` is the 1-based place of the run's first row within its group."""
    if not by:
        return scans.runs(df, order, value)
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    island = place - F.row_number().over(W.partitionBy(*by, value).orderBy(*order))
    rows = df.select(*by, value, place.alias("place"), island.alias("island"))
    out = rows.groupBy(*by, value, "island").agg(F.min("place").alias("start"), F.count("*").alias("size"))
    return out.select(*by, value, F.row_number().over(W.partitionBy(*by).orderBy("start")).alias("run"), "start", "size")


def longest_runs(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """The longest run of each group, the first of equals."""
    best = W.partitionBy(*by).orderBy(F.desc("size"), "start")
    return runs(df, by, order, value).withColumn("r", F.row_number().over(best)).where("r = 1").drop("r", "run")


def successive_differ(paths: DataFrame) -> DataFrame:
    """repeats: segments whose donor equals that of the segment before (0)."""
    order = W.partitionBy("hap").orderBy("segment")
    return paths.select("hap", "segment", "donor").distinct().withColumn("p", F.lag("donor").over(order)).agg(F.count_if(F.col("p") == F.col("donor")).alias("repeats"))
