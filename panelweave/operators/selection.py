"""Exact quantiles by distributed selection.

A double has a 64-bit key that sorts as it does.  Sixteen bits of the keys at a
time are counted, first in each task and then over all; only the buckets that
hold a wanted rank are counted on by their next bits.  After four rounds a
bucket is one value, however often it comes.  No task sees more than the 65,536
counts of a bucket, and no row is ever sorted or sent on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.shared import written

BITS, ROUNDS = 16, 4


def sort_key(x: np.ndarray) -> np.ndarray:
    """Signed numbers that sort as the doubles do; minus zero is zero."""
    bits = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


def of_key(key: np.ndarray) -> np.ndarray:
    key = np.asarray(key, np.int64)
    return np.where(key < 0, key ^ np.int64((1 << 63) - 1), key).view(np.float64)


def keyed(df: DataFrame, value: str, by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """by, value and key of each row with a value that is a number; written.
    With ``weight``, a row stands for as many as that column says."""
    rows = df.select(*by, *([weight] if weight else []), F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull() & ~F.isnan(value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("key", pa.array(sort_key(b.column(b.num_columns - 1).to_numpy())))

    return written(rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("key", LongType(), False)])), "keys")


def quantiles(rows: DataFrame, wanted: tuple[float, ...], by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """by and ``q``: the quantiles of the ``keyed`` rows of each group, linear
    between neighbours.  A group without rows has none."""
    every = F.lit(0).alias("__all")
    rows = rows.select(every, *by, "key", (F.col(weight) if weight else F.lit(1)).cast("long").alias("__w")).where("__w > 0")
    groups = ["__all", *by]
    sizes = rows.groupBy(*groups).agg(F.sum("__w").alias("n"))
    at = F.col("p") * (F.col("n") - 1).cast("double")
    asked = sizes.select(*groups, "n", F.posexplode(F.array(*map(F.lit, map(float, wanted)))).alias("k", "p"))
    asked = asked.withColumn("share", at - F.floor(at)).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    asked = asked.withColumn("rank", F.when(F.col("side") == 0, F.floor(at)).otherwise(F.ceil(at)).cast("long"))
    # ranks within the bucket so far, which is the whole group
    asked = written(asked.select(*groups, "k", "side", "share", "rank", F.lit(0).cast("long").alias("bucket")), "ranks")
    for n in range(1, ROUNDS + 1):
        held = F.lit(0).cast("long") if n == 1 else F.shiftright("key", 64 - BITS * (n - 1))
        here = rows.select(*groups, held.alias("bucket"), F.shiftright("key", 64 - BITS * n).alias("next"), "__w")
        if n > 1:  # two ranks a quantile and group
            here = here.join(asked.select(*groups, "bucket").distinct(), [*groups, "bucket"], "left_semi")
        counts = here.groupBy(*groups, "bucket", "next").agg(F.sum("__w").alias("c"))
        upto = F.sum("c").over(W.partitionBy(*groups, "bucket").orderBy("next"))
        counts = counts.withColumn("before", upto - F.col("c"))
        met = asked.join(counts, [*groups, "bucket"]).where("before <= rank and rank < before + c")
        asked = written(met.select(*groups, "k", "side", "share", (F.col("rank") - F.col("before")).alias("rank"), F.col("next").alias("bucket")), "ranks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("x", pa.array(of_key(b.column(b.num_columns - 1).to_numpy())))

    found = asked.select(*by, "k", "side", "share", F.col("bucket").alias("key"))
    found = found.mapInArrow(run, StructType([*found.schema.fields, StructField("x", DoubleType())]))
    x = lambda side: F.max(F.when(F.col("side") == side, F.col("x")))
    each = found.groupBy(*by, "k", "share").agg(x(0).alias("lo"), x(1).alias("hi"))
    value = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + F.col("share") * (F.col("hi") - F.col("lo")))
    return each.groupBy(every, *by).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", value.alias("v")))), lambda s: s["v"]).alias("q")).drop("__all")


def with_quantiles(summary: DataFrame, rows: DataFrame, wanted: tuple[float, ...], by: tuple[str, ...] = (), weight: str | None = None) -> DataFrame:
    """``summary``, a row a group, with ``q`` of the group's ``keyed`` rows."""
    found = quantiles(rows, wanted, by, weight)
    if by:
        return summary.join(found, list(by), "left")
    return summary.withColumn("__all", F.lit(0)).join(F.broadcast(found.withColumn("__all", F.lit(0))), "__all", "left").drop("__all")


def ranked(df: DataFrame, value: str, by: tuple[str, ...], weight: str) -> DataFrame:
    """by, value and weight with before, upto and n: the ranks that a row stands
    for among its group's.  A group is put in order by one task, so its rows must
    be few, whatever their weights sum to."""
    within = W.partitionBy(*by)
    upto = F.sum(weight).over(within.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = df.where(F.col(weight) > 0).select(*by, value, weight, upto.alias("upto"), F.sum(weight).over(within).alias("n"))
    return rows.withColumn("before", F.col("upto") - F.col(weight))


def at_rank(value: str, p: float) -> Column:
    """The quantile ``p`` of a group of ``ranked`` rows (an aggregate), linear between neighbours."""
    at = F.lit(float(p)) * (F.col("n") - 1).cast("double")
    x = lambda rank: F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), F.col(value)))
    lo, hi, share = x(F.floor(at)), x(F.ceil(at)), F.max(at - F.floor(at))
    return F.when(lo == hi, lo).otherwise(lo + share * (hi - lo))
