"""Samples that depend on their seed and on nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import half_even_index, with_uniforms


def systematic_floor(spark: SparkSession, n: int, k: int) -> DataFrame:
    """Distinct floor() of k evenly spaced places 1..n."""
    i = F.col("id").cast("double")
    return spark.range(k).select(F.floor(1 + i * (n - 1) / max(k - 1, 1)).cast("long").alias("place")).distinct()


def systematic_round(spark: SparkSession, n: int, k: int) -> DataFrame:
    """Distinct places 1..n of k evenly spaced ones, rounded half to even."""
    return spark.range(k).select(half_even_index(F.col("id"), F.lit(n), F.lit(k)).alias("place")).distinct()


def seeded_subsets(ids: DataFrame, key: str, size: int, replicates: int, seed: int) -> DataFrame:
    """replicate and key: ``size`` ids of each replicate, drawn without
    replacement by the rank of a seeded draw; ties go to the smaller id."""
    reps = ids.sparkSession.range(replicates).select(F.col("id").cast("int").alias("replicate"))
    rows = with_uniforms(ids.select(key).distinct().join(reps), F.col(key), F.col("replicate"), seed, u=1)
    rank = F.row_number().over(W.partitionBy("replicate").orderBy("u", key))
    return rows.withColumn("rank", rank).where(F.col("rank") <= size).select("replicate", key)


def sampled_pairs(spark: SparkSession, n: int, pairs: int, seed: int) -> DataFrame:
    """``pairs`` distinct i1 < i2 out of n individuals, by seeded rank.

    Every pair has a draw; the smallest ones are taken by a bounded top-k."""
    ids = spark.range(n).select(F.col("id").cast("int").alias("i1"))
    every = ids.select("i1", F.explode(F.sequence(F.col("i1") + 1, F.lit(n))).alias("i2")).where(F.col("i2") < n)
    return with_uniforms(every, F.col("i1"), F.col("i2"), seed, u=1).orderBy("u", "i1", "i2").limit(pairs).select("i1", "i2")
