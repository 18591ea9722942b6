"""A genotype panel derived from ``embeddings``: 64 markers a sample.

Sample i is vec_id, marker j the place in the vector; a component below -0.1
is dosage 0, one above 0.1 dosage 2, else 1.  Markers lie 4 kb apart.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import require

MARKERS = 64


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that driver and executors share: below
    ``spark.checkpoint.dir``; a temporary one only where there is one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        require(spark.sparkContext.master.startswith("local"), "set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.gettempdir()
    base = "/" + base[5:].lstrip("/") if base.startswith("file:") else base
    require("://" not in base, "single files are written to a mounted folder")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """i, j, d and label of each call."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("i"), "label", F.posexplode("embedding").alias("j", "e"))
    e = F.col("e").cast("double")
    return rows.select("i", "j", F.when(e < -0.1, 0).when(e > 0.1, 2).otherwise(1).alias("d"), "label")


def markers(spark: SparkSession) -> DataFrame:
    """j, bp and morgan of the markers."""
    return spark.range(MARKERS).select(F.col("id").cast("int").alias("j"), (F.col("id") * 4000).alias("bp"), (F.col("id") * 4000 / F.lit(1e8)).alias("morgan"))


PANEL = """p0 as (select cast(vec_id as int) as i, label, cast(unnest(range(64)) as int) as j, cast(unnest(embedding) as double) as e from embeddings),
g as (select i, j, label, case when e < -1e-1 then 0 when e > 1e-1 then 2 else 1 end as d from p0)"""
MAP = "m as (select cast(r.range as int) as j, cast(r.range * 4000 as bigint) as bp, r.range * 4000 / 1e8 as morgan from range(64) r)"
KING = """k0 as (select a.i as i1, b.i as i2, sum(case when a.d = 1 and b.d = 1 then 1 else 0 end) as hh,
  sum(case when abs(a.d - b.d) = 2 then 1 else 0 end) as ibs0, sum(case when a.d = 1 then 1 else 0 end) + sum(case when b.d = 1 then 1 else 0 end) as den
  from g a join g b on a.j = b.j and a.i < b.i group by 1, 2),
king as (select i1, i2, cast(hh - 2 * ibs0 as double) / den as kinship from k0 where den > 0)"""
R2 = """s as (select a.j as j1, b.j as j2, cast(count(*) as double) as n, cast(sum(a.d) as double) as x, cast(sum(b.d) as double) as y,
  cast(sum(a.d * a.d) as double) as xx, cast(sum(b.d * b.d) as double) as yy, cast(sum(a.d * b.d) as double) as xy
  from g a join g b on a.i = b.i and a.j < b.j group by 1, 2),
r2 as (select j1, j2, cast(4000 * (j2 - j1) as bigint) as dist, coalesce((n * xy - x * y) * (n * xy - x * y) / nullif((n * xx - x * x) * (n * yy - y * y), 0e0), 0e0) as r2 from s)"""
BIN = "case when dist < 10000 then '0-10kb' when dist < 50000 then '10-50kb' when dist < 100000 then '50-100kb' when dist < 500000 then '100-500kb' when dist < 1000000 then '500kb-1Mb' else '>1Mb' end"
