"""Quality control of a genotype panel before it is released.

    python -m jobs.panel_qc VECTORS OUT [--config FILE]

Reads a table of vectors (vec_id, embedding), a component a marker, as calls.
Samples with too many missing calls and copies of earlier samples go; markers of
the rest must pass on missingness, allele frequency and Hardy-Weinberg
proportions, and of markers in strong linkage the earlier one stays.  Writes

* ``OUT/samples``: each sample's missingness and verdict,
* ``OUT/markers``, by ``block``: each marker's statistics and verdict,
* ``OUT/calls``, by ``block``: the calls that are released.

Each is replaced as a whole, so that a run after a broken one, or over changed
input, leaves what a first run would.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.operators import genotype, linkage

log = logging.getLogger("panel_qc")


def calls_of(vectors: DataFrame, low: float, high: float) -> DataFrame:
    """i, j, d: dosages of the vectors' components; null and NaN are missing."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("i"), F.posexplode("embedding").alias("j", "e"))
    e = F.col("e").cast("double")
    d = F.when(e.isNull() | F.isnan(e), None).when(e < low, 0).when(e > high, 2).otherwise(1)
    return rows.select("i", "j", d.cast("tinyint").alias("d"))


def hwe_chi2(n0: Column, n1: Column, n2: Column) -> Column:
    """Squared distance from Hardy-Weinberg proportions; 0 if one allele is missing."""
    n0, n1, n2 = (c.cast("double") for c in (n0, n1, n2))
    n, p = n0 + n1 + n2, (2 * n2 + n1) / (2 * (n0 + n1 + n2))
    parts = [(n0, n * (1 - p) * (1 - p)), (n1, 2 * n * p * (1 - p)), (n2, n * p * p)]
    return sum((F.coalesce(F.try_divide((o - e) * (o - e), e), F.lit(0.0)) for o, e in parts), F.lit(0.0))


def judge_samples(calls: DataFrame, most_missing: float) -> DataFrame:
    """i, n_missing, missingness, verdict (keep, missing or copy) of each sample."""
    stats = calls.groupBy("i").agg(F.count_if(F.col("d").isNull()).alias("n_missing"), F.avg(F.col("d").isNull().cast("double")).alias("missingness"))
    first = genotype.first_of_identical(calls, "i", "j").select("i", F.col("first").alias("of"))
    verdict = F.when(F.col("missingness") > most_missing, "missing").when(F.col("of") < F.col("i"), "copy").otherwise("keep")
    return stats.join(first, "i").select("i", "n_missing", "missingness", verdict.alias("verdict"))


def judge_markers(calls: DataFrame, s: dict) -> DataFrame:
    """block, j, bp, statistics, verdict (keep, missing, rare, hwe or linked)."""
    level = lambda k: F.count_if(F.col("d") == k)
    stats = genotype.marker_stats(calls).join(calls.groupBy("j").agg(hwe_chi2(level(0), level(1), level(2)).alias("hwe_chi2")), "j")
    missing = F.col("n_missing") / (F.col("n_calls") + F.col("n_missing"))
    alone = F.when(missing > s["max_marker_missing"], "missing").when(F.coalesce(F.col("maf"), F.lit(0.0)) < s["min_maf"], "rare").when(F.col("hwe_chi2") > s["max_hwe_chi2"], "hwe")
    stats = stats.select("j", (F.col("j").cast("long") * s["step"]).alias("bp"), "n_calls", "n_missing", "maf", "heterozygosity", "hwe_chi2", alone.alias("alone"))
    passing = stats.where("alone is null").select("j", "bp")
    pairs = linkage.pair_r2(calls.join(passing, "j", "left_semi"), linkage.marker_pairs(passing, s["ld_window"]))
    linked = pairs.where(F.col("r2") > s["max_r2"]).select(F.col("j2").alias("j")).distinct().withColumn("linked", F.lit("linked"))
    verdict = F.coalesce("alone", "linked", F.lit("keep")).alias("verdict")
    return stats.join(linked, "j", "left").select(F.floor(F.col("j") / s["block"]).cast("int").alias("block"), "j", "bp", "n_calls", "n_missing", "maf", "heterozygosity", "hwe_chi2", verdict)


def write(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Replace a table, read it back, log its rows by verdict.

    The table as a whole, so that none of its blocks stays where the new one has
    no such block; a table without rows has no file to take a schema from."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    told = "verdict" if "verdict" in df.columns else F.lit("rows")
    log.info("wrote %s: %s", path, ", ".join(f"{n} {k}" for k, n in out.groupBy(told).count().collect()) or "0 rows")
    return out


def run(spark: SparkSession, vectors: str, out: str, settings: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The job: read ``vectors``, replace the three tables of ``out``; they are
    read back as samples, markers and calls.

    A null vec_id or vector has no calls and so no row anywhere; vectors may
    differ in length; rows of an empty table are none.
    """
    s = settings
    table = spark.read.parquet(vectors).select("vec_id", "embedding").where("vec_id is not null")
    calls = calls_of(table, s["low"], s["high"])
    log.info("read %s: %s vectors", vectors, table.count())
    samples = write(judge_samples(calls, s["max_sample_missing"]), f"{out}/samples")
    kept = calls.join(samples.where("verdict = 'keep'").select("i"), "i", "left_semi")
    markers = write(judge_markers(kept, s), f"{out}/markers", "block")
    released = kept.join(markers.where("verdict = 'keep'").select("block", "j"), "j").select("block", "j", "i", "d")
    return samples, markers, write(released.repartitionByRange("block", "j"), f"{out}/calls", "block")


def main(argv: list[str] | None = None) -> int:
    from jobs import common

    return common.main("panel_qc", {"vectors": "Parquet table of vectors (vec_id, embedding)", "out": "folder of the three tables"}, run, argv)


if __name__ == "__main__":
    sys.exit(main())
