"""Donor overlap: which haplotypes copy the same donor at the same place.

Segments, not cells, are joined: two segments of one donor that share a block
of markers may overlap, and each overlap is taken once, in the block where it
begins.  A donor's segments meet by block, so a popular donor's rows spread
over as many keys as there are blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 64


def shared_tracts(segs: DataFrame, block: int = BLOCK) -> DataFrame:
    """h1 < h2, start_j, end_j of each maximal run of markers with equal donors."""
    s = segs.select("hap", "donor", "start_j", "end_j").withColumn("block", F.explode(F.sequence(F.floor(F.col("start_j") / block), F.floor(F.col("end_j") / block))))
    a = s.withColumnsRenamed({"hap": "h1", "start_j": "s1", "end_j": "e1"})
    b = s.withColumnsRenamed({"hap": "h2", "start_j": "s2", "end_j": "e2"})
    start, end = F.greatest("s1", "s2"), F.least("e1", "e2")
    hits = a.join(b, ["donor", "block"]).where((F.col("h1") < F.col("h2")) & (start <= end) & (F.floor(start / block) == F.col("block")))
    hits = hits.select("h1", "h2", start.alias("start_j"), end.alias("end_j"))
    # runs that touch (both haplotypes switch to one donor together) are one
    order = W.partitionBy("h1", "h2").orderBy("start_j")
    fresh = (F.coalesce(F.lag("end_j").over(order), F.lit(-2)) + 1 < F.col("start_j")).cast("int")
    runs = hits.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order))
    return runs.groupBy("h1", "h2", "run").agg(F.min("start_j").alias("start_j"), F.max("end_j").alias("end_j")).drop("run")


def haplotype_overlap(segs: DataFrame, markers: DataFrame, block: int = BLOCK) -> DataFrame:
    """h1, h2, overlap (share of markers), longest_morgan, longest_bp of pairs
    that share a marker; the two lengths are maxima of their own."""
    n = markers.count()
    ends = markers.select("j", "morgan", "bp")
    runs = shared_tracts(segs, block)
    runs = runs.join(ends.withColumnsRenamed({"j": "start_j", "morgan": "m0", "bp": "b0"}), "start_j").join(ends.withColumnsRenamed({"j": "end_j", "morgan": "m1", "bp": "b1"}), "end_j")
    return runs.groupBy("h1", "h2").agg((F.sum(F.col("end_j") - F.col("start_j") + 1).cast("double") / n).alias("overlap"), F.max(F.col("m1") - F.col("m0")).alias("longest_morgan"), F.max(F.col("b1") - F.col("b0")).alias("longest_bp"))


def individual_overlap(segs: DataFrame, markers: DataFrame, n_individuals: int, block: int = BLOCK) -> DataFrame:
    """i1 < i2 with mean and max overlap of their four haplotype pairs and the
    longest shared tract, for every pair of individuals."""
    pairs = haplotype_overlap(segs, markers, block).select(F.floor(F.col("h1") / 2).cast("int").alias("i1"), F.floor(F.col("h2") / 2).cast("int").alias("i2"), "overlap", "longest_morgan", "longest_bp").where("i1 < i2")
    sums = pairs.groupBy("i1", "i2").agg((F.sum("overlap") / 4).alias("mean_overlap"), F.max("overlap").alias("max_overlap"), F.max("longest_morgan").alias("longest_morgan"), F.max("longest_bp").alias("longest_bp"))
    ids = segs.sparkSession.range(n_individuals).select(F.col("id").cast("int").alias("i1"))
    every = ids.select("i1", F.explode(F.sequence(F.col("i1") + 1, F.lit(n_individuals))).alias("i2")).where(F.col("i2") < n_individuals)
    zero = {c: F.coalesce(c, F.lit(0)).cast("long" if c == "longest_bp" else "double") for c in ("mean_overlap", "max_overlap", "longest_morgan", "longest_bp")}
    return every.join(sums, ["i1", "i2"], "left").withColumns(zero)


def with_pair_values(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Attach a value of (i1, i2) such as kinship; null where there is none."""
    return pairs.join(values.select("i1", "i2", name), ["i1", "i2"], "left")


def sampled_longest(segs: DataFrame, markers: DataFrame, pairs: DataFrame, block: int = BLOCK) -> DataFrame:
    """For chosen (i1, i2): mean and max overlap, longest_morgan, and the base
    pairs of that same run (the first of the longest ones)."""
    n = markers.count()
    ends = markers.select("j", "morgan", "bp")
    chosen = pairs.select("i1", "i2").distinct()
    runs = shared_tracts(segs, block).withColumn("i1", F.floor(F.col("h1") / 2).cast("int")).withColumn("i2", F.floor(F.col("h2") / 2).cast("int")).join(chosen, ["i1", "i2"])
    runs = runs.join(ends.withColumnsRenamed({"j": "start_j", "morgan": "m0", "bp": "b0"}), "start_j").join(ends.withColumnsRenamed({"j": "end_j", "morgan": "m1", "bp": "b1"}), "end_j")
    runs = runs.withColumns({"m": F.col("m1") - F.col("m0"), "bp": F.col("b1") - F.col("b0"), "size": F.col("end_j") - F.col("start_j") + 1})
    by_hap = runs.groupBy("i1", "i2", "h1", "h2").agg((F.sum("size").cast("double") / n).alias("o"), F.max(F.struct("m", (-F.col("start_j")).alias("s"), "bp")).alias("best"))
    out = by_hap.groupBy("i1", "i2").agg((F.sum("o") / 4).alias("mean_overlap"), F.max("o").alias("max_overlap"), F.max(F.struct("best.m", (-F.col("h1")).alias("a"), (-F.col("h2")).alias("b"), "best.bp")).alias("best"))
    full = chosen.join(out, ["i1", "i2"], "left")
    return full.select("i1", "i2", F.coalesce("mean_overlap", F.lit(0.0)).alias("mean_overlap"), F.coalesce("max_overlap", F.lit(0.0)).alias("max_overlap"), F.coalesce("best.m", F.lit(0.0)).alias("longest_morgan"), F.coalesce("best.bp", F.lit(0)).cast("long").alias("longest_bp"))


def sampled_summary(sampled: DataFrame) -> DataFrame:
    """One row over sampled pairs: pairs, means, medians and 99.5 percentiles."""
    cols = ("mean_overlap", "max_overlap", "longest_morgan", "longest_bp")
    return sampled.agg(F.count("*").alias("pairs"), *(f for c in cols for f in (F.avg(c).alias(f"mean_of_{c}"), F.median(c).alias(f"median_of_{c}"), F.percentile(c, F.lit(0.995)).alias(f"q995_of_{c}"))))
