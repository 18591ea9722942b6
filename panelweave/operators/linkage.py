"""Linkage disequilibrium: pairs of markers within a distance, bins, scores.

``markers`` has (j, bp) and, for panels of several chromosomes, chr.  Pairs are
found by an equi-join on position buckets of one window's width, never by
comparing all markers; each pair then meets its calls by sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import distance_bin, squared_correlation
from ..functions.columns import DISTANCE_BINS
from .genotype import wide_markers
from .tiles import window_r2

WINDOW = 1_000_000


def marker_pairs(markers: DataFrame, window: int = WINDOW) -> DataFrame:
    """j1 < j2 at most ``window`` base pairs apart (inclusive), with dist."""
    keys = ["chr"] if "chr" in markers.columns else []
    m = markers.select(*keys, "j", "bp", F.floor(F.col("bp") / window).cast("long").alias("b"))
    left = m.withColumnsRenamed({"j": "j1", "bp": "bp1"}).withColumn("b", F.explode(F.array(F.col("b"), F.col("b") + 1, F.col("b") - 1)))
    right = m.withColumnsRenamed({"j": "j2", "bp": "bp2"})
    dist = F.abs(F.col("bp2") - F.col("bp1"))
    return left.join(right, [*keys, "b"]).where((F.col("j1") < F.col("j2")) & (dist <= window)).select("j1", "j2", dist.cast("long").alias("dist"))


def all_pairs(markers: DataFrame) -> DataFrame:
    """Every j1 < j2, for small marker sets: the upper triangle."""
    m = markers.select("j", "bp")
    left, right = m.withColumnsRenamed({"j": "j1", "bp": "bp1"}), m.withColumnsRenamed({"j": "j2", "bp": "bp2"})
    return left.join(right, F.col("j1") < F.col("j2")).select("j1", "j2", F.abs(F.col("bp2") - F.col("bp1")).cast("long").alias("dist"))


def pair_r2(calls: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add r2 to pairs: squared sample correlation of the dosages, 0 for a
    marker that does not vary.  Samples without either call are left out."""
    x, y = calls.select("i", F.col("j").alias("j1"), F.col("d").cast("long").alias("x")), calls.select("i", F.col("j").alias("j2"), F.col("d").cast("long").alias("y"))
    rows = pairs.join(x, "j1").join(y, ["i", "j2"]).where("x is not null and y is not null")
    sums = rows.groupBy("j1", "j2", "dist").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    return sums.select("j1", "j2", "dist", squared_correlation(*(F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))).alias("r2"))


def window_ld(calls: DataFrame, markers: DataFrame, window: int = WINDOW) -> DataFrame:
    """j1, j2, dist, r2 of all pairs within the window, for panels of any size:
    tiles of neighbouring markers meet as matrices, and only pairs come out.
    ``pair_r2`` is the relational form, for chosen pairs."""
    return window_r2(wide_markers(calls), markers, window)


def correlations(calls: DataFrame, markers: DataFrame, window: int = WINDOW) -> DataFrame:
    """j1, j2, dist and the signed correlation r; 0 where a side does not vary."""
    return window_r2(wide_markers(calls), markers, window, signed=True).withColumnRenamed("r2", "r")


def by_distance(r2: DataFrame) -> DataFrame:
    """bin, pairs, mean_r2, median_r2 of all six bins; an empty bin has 0 pairs and nulls."""
    bins = r2.sparkSession.createDataFrame([(b,) for b in DISTANCE_BINS], "bin string")
    got = r2.groupBy(distance_bin(F.col("dist")).alias("bin")).agg(F.count("*").alias("pairs"), F.avg("r2").alias("mean_r2"), F.median("r2").alias("median_r2"))
    return bins.join(got, "bin", "left").select("bin", F.coalesce("pairs", F.lit(0)).cast("long").alias("pairs"), "mean_r2", "median_r2")


def ld_scores(r2: DataFrame, markers: DataFrame) -> DataFrame:
    """j and ld_score: sum of r2 with both neighbours' sides, 0 for no pair."""
    ends = r2.select(F.explode(F.array("j1", "j2")).alias("j"), "r2").groupBy("j").agg(F.sum("r2").alias("s"))
    return markers.select("j").join(ends, "j", "left").select("j", F.coalesce("s", F.lit(0.0)).alias("ld_score"))


def effective_rank(calls: DataFrame, markers: DataFrame) -> DataFrame:
    """M squared over the sum of all squared correlations, diagonal included;
    a number a pair of tiles leaves its task."""
    m = markers.agg(F.count("*").alias("m"))
    everything = markers.agg(F.max("bp") - F.min("bp")).first()[0] or 0
    s = window_r2(wide_markers(calls), markers, everything, summed=True).agg(F.coalesce(F.sum("r2"), F.lit(0.0)).alias("s"))
    return m.join(s).select((F.col("m").cast("double") * F.col("m") / (F.col("m") + 2 * F.col("s"))).alias("effective_rank"))
