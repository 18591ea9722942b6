"""Reference-conditioned haplotype mosaics as prefix sums.

A synthetic haplotype copies one donor until a switch, which happens between
neighbouring markers with probability 1 - exp(-rate * distance) and leads to
another donor, each with equal chance.  The draws are counter based, and "any
other donor" is an offset of 1..D-1 modulo D, so the donor at a marker is the
running sum of offsets modulo D.  Blocks, order and partitioning don't matter.

haplotypes: (hap); markers: (j, morgan); donors are numbered 0..D-1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import require, with_uniforms
from ..functions.checks import hold


def check_inputs(alleles: DataFrame, markers: DataFrame, n: int, rate: float) -> None:
    """Alleles are 0 or 1 and complete; the map is finite and never decreases."""
    hold(alleles, binary_haplotypes=F.col("allele").isin(0, 1))
    steps = markers.select((F.col("morgan") - F.lag("morgan").over(W.orderBy("j"))).alias("step"), "morgan")
    hold(steps, monotone_map=F.col("morgan").isNotNull() & ~F.isnan("morgan") & (F.coalesce("step", F.lit(0.0)) >= 0))
    require(n >= 1, "at least one haplotype is needed")
    require(rate >= 0 and rate != float("inf"), "the copy rate must be finite and not negative")


def map_steps(markers: DataFrame) -> DataFrame:
    """Add delta, the distance from the marker before, and first, whether the
    marker begins a chromosome.  The marker table is the small side of every
    mosaic (a row a marker)."""
    order = W.partitionBy(*(["chr"] if "chr" in markers.columns else [])).orderBy("j")
    before = F.lag("morgan").over(order)
    return markers.withColumns({"delta": F.coalesce(F.col("morgan") - before, F.lit(0.0)), "first": before.isNull()})


def _draws(haplotypes: DataFrame, steps: DataFrame, n_donors: int, rate: float, seed: int) -> DataFrame:
    """hap, j, (block,) switched, step (the donor's offset), tract (1 where one begins)."""
    keys = [c for c in ("block",) if c in steps.columns]
    rows = with_uniforms(haplotypes.select("hap").join(steps.select("j", "delta", "first", *keys)), F.col("hap"), F.col("j"), seed, u1=1, u2=2, u3=3)
    chance = -F.expm1(-F.lit(float(rate)) * F.col("delta"))
    rows = rows.withColumn("switched", (~F.col("first") & (F.col("u1") < chance) & F.lit(n_donors > 1)).cast("int"))
    step = F.when(F.col("first"), F.floor(F.col("u3") * n_donors)).when(F.col("switched") == 1, 1 + F.floor(F.col("u2") * (n_donors - 1))).otherwise(0).cast("long")
    return rows.select("hap", "j", *keys, "switched", step.alias("step"), (F.col("first") | (F.col("switched") == 1)).cast("int").alias("tract"))


def block_offsets(haplotypes: DataFrame, markers: DataFrame, n_donors: int, rate: float, seed: int) -> DataFrame:
    """hap, block, steps, tracts: the sums over all earlier blocks.

    With them a block's paths need that block's draws only, so the blocks of a
    long chromosome run apart, and a resumed build makes what is missing."""
    draws = _draws(haplotypes, map_steps(markers), n_donors, rate, seed)
    sums = draws.groupBy("hap", "block").agg(F.sum("step").alias("s"), F.sum("tract").alias("t"))
    before = W.partitionBy("hap").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return sums.select("hap", "block", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("steps"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("tracts"))


def block_paths(haplotypes: DataFrame, steps: DataFrame, offsets: DataFrame, n_donors: int, rate: float, seed: int) -> DataFrame:
    """donor_paths of the blocks in ``steps`` (map_steps of the whole map, then
    filtered) and ``offsets``."""
    rows = _draws(haplotypes, steps, n_donors, rate, seed).join(offsets, ["hap", "block"])
    along = W.partitionBy("hap", "block").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    return rows.select(
        "hap",
        "j",
        "switched",
        F.pmod(F.col("steps") + F.sum("step").over(along), F.lit(n_donors)).cast("int").alias("donor"),
        (F.col("tracts") + F.sum("tract").over(along) - 1).cast("int").alias("segment"),
    )


def donor_paths(haplotypes: DataFrame, markers: DataFrame, n_donors: int, rate: float, seed: int) -> DataFrame:
    """hap, j, switched, donor, segment for each haplotype and marker.

    The result has as many rows as the panel has alleles.  Where the markers
    name their block, prefix sums run within (haplotype, block) on top of the
    blocks' own; else one window partition a haplotype holds all markers.
    """
    require(n_donors >= 1, "at least one donor is needed")
    if "block" in markers.columns:
        return block_paths(haplotypes, map_steps(markers), block_offsets(haplotypes, markers, n_donors, rate, seed), n_donors, rate, seed)
    along = W.partitionBy("hap").orderBy("j").rowsBetween(W.unboundedPreceding, 0)
    return _draws(haplotypes, map_steps(markers), n_donors, rate, seed).select("hap", "j", "switched", F.pmod(F.sum("step").over(along), F.lit(n_donors)).cast("int").alias("donor"), (F.sum("tract").over(along) - 1).cast("int").alias("segment"))


def segments(paths: DataFrame, markers: DataFrame, mode: str = "closed") -> DataFrame:
    """hap, segment, donor, start_j, end_j, markers, morgan (and bp if known).

    ``closed`` measures a tract from its first to its last marker (a tract of
    one marker is 0); ``to_next`` up to the marker that starts the next one.
    """
    require(mode in ("closed", "to_next"), f"unknown mode {mode}")
    place = [c for c in ("morgan", "bp") if c in markers.columns]
    rows = paths.join(markers.select("j", *place), "j")
    out = rows.groupBy("hap", "segment").agg(F.min("donor").alias("donor"), F.min("j").alias("start_j"), F.max("j").alias("end_j"), F.count("*").alias("markers"), *(F.min(c).alias(f"from_{c}") for c in place), *(F.max(c).alias(f"to_{c}") for c in place))
    if mode == "to_next":
        after = W.partitionBy("hap").orderBy("segment")
        out = out.withColumns({f"to_{c}": F.coalesce(F.lead(f"from_{c}").over(after), F.col(f"to_{c}")) for c in place})
    return out.select("hap", "segment", "donor", "start_j", "end_j", "markers", *((F.col(f"to_{c}") - F.col(f"from_{c}")).alias(c) for c in place))


def segment_summary(segs: DataFrame) -> DataFrame:
    """Mean, median, 2.5 and 97.5 percentiles of switches and donors of a
    haplotype and of the length of a tract; one row."""
    by_hap = segs.groupBy("hap").agg((F.count("*") - 1).alias("switches"), F.count_distinct("donor").alias("donors"))

    def four(df: DataFrame, c: str) -> DataFrame:
        return df.agg(F.avg(c).alias(f"mean_{c}"), *(F.percentile(c, F.lit(q)).alias(f"{n}_{c}") for n, q in (("median", 0.5), ("q025", 0.025), ("q975", 0.975))))

    out = four(by_hap, "switches").join(four(by_hap, "donors"))
    for c in ("markers", *(x for x in ("morgan", "bp") if x in segs.columns)):
        out = out.join(four(segs, c))
    return out


def haplotype_alleles(paths: DataFrame, donors: DataFrame) -> DataFrame:
    """hap, j, allele: the donor's allele at each marker (donor, j, allele)."""
    return paths.join(donors, ["donor", "j"]).select("hap", "j", "allele")


def diploid(alleles: DataFrame) -> DataFrame:
    """i, j, d: haplotypes 2i and 2i + 1 make sample i; no join needed."""
    return alleles.groupBy(F.floor(F.col("hap") / 2).cast("int").alias("i"), "j").agg(F.sum("allele").cast("int").alias("d"))


def segments_to_donors(segs: DataFrame, n_haplotypes: int, n_markers: int) -> DataFrame:
    """hap, j, donor from segments that must tile every haplotype exactly."""
    rows = segs.select("hap", F.explode(F.sequence("start_j", "end_j")).alias("j"), "donor")
    cells = rows.groupBy("hap", "j").agg(F.count("*").alias("c"))
    got = cells.agg(F.count("*").alias("n"), F.coalesce(F.max("c"), F.lit(0)).alias("most"), F.count_if((F.col("hap") < 0) | (F.col("hap") >= n_haplotypes) | (F.col("j") < 0) | (F.col("j") >= n_markers)).alias("foreign")).first()
    require(got["foreign"] == 0, "segments name foreign haplotypes or markers")
    require(got["most"] <= 1, "segments overlap")
    require(got["n"] == n_haplotypes * n_markers, "segments leave gaps")
    return rows


def select_copy_rate(rates: DataFrame, *flags: str) -> DataFrame:
    """copy_rate: the highest finite rate whose flags all hold, else null."""
    ok = F.lit(True)
    for f in flags:
        ok = ok & F.coalesce(F.col(f), F.lit(False))
    finite = ~F.isnan("rate") & (F.abs("rate") < float("inf"))
    return rates.agg(F.max(F.when(ok & finite, F.col("rate"))).alias("copy_rate"))
