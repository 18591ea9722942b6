"""Statistics of genotype calls (i sample, j marker, d dosage 0/1/2 or null)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import maf, ratio
from ..functions.checks import hold


def marker_stats(calls: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One pass: j, n_calls, n_missing, maf, heterozygosity, variance, levels;
    of each group of ``by`` if given."""
    d = F.col("d").cast("double")
    return calls.groupBy(*by, "j").agg(
        F.count("d").alias("n_calls"),
        F.count_if(F.col("d").isNull()).alias("n_missing"),
        maf(F.col("d")).alias("maf"),
        F.avg(F.when(F.col("d") == 1, 1.0).when(F.col("d").isNotNull(), 0.0)).alias("heterozygosity"),
        F.var_samp(d).alias("variance"),
        F.count_distinct("d").alias("levels"),
    )


def panel_stats(calls: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """heterozygosity and missingness over all cells of the panel."""
    return calls.groupBy(*by).agg(
        F.avg(F.when(F.col("d") == 1, 1.0).when(F.col("d").isNotNull(), 0.0)).alias("heterozygosity"),
        F.avg(F.col("d").isNull().cast("double")).alias("missingness"),
        F.count("*").alias("cells"),
    )


def polymorphic(calls: DataFrame) -> DataFrame:
    """Calls of the markers that vary."""
    keep = calls.groupBy("j").agg(F.var_samp(F.col("d").cast("double")).alias("v")).where("v > 0").select("j")
    return calls.join(keep, "j", "left_semi")


def monomorphic_count(calls: DataFrame) -> DataFrame:
    """Markers with fewer than two distinct calls."""
    return calls.groupBy("j").agg(F.count_distinct("d").alias("levels")).agg(F.count_if(F.col("levels") < 2).alias("monomorphic"))


def sex_aware_missingness(calls: DataFrame, chr_col: str = "chr", sex_col: str = "sex") -> DataFrame:
    """missing, eligible, missingness; a female's slots on Y do not count."""
    eligible = ~((F.col(chr_col) == "Y") & (F.col(sex_col) == 2))
    return calls.where(eligible).agg(F.count_if(F.col("d").isNull()).alias("missing"), F.count("*").alias("eligible")).select("missing", "eligible", ratio(F.col("missing"), F.col("eligible")).alias("missingness"))


def bed_bytes(n_samples: Column, n_markers: Column) -> Column:
    """Size of a SNP-major BED file: three magic bytes and two bits a call."""
    return (3 + n_markers * F.ceil(n_samples / 4)).cast("long")


def fingerprint_parts(calls: DataFrame, by: str, along: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Four sums of each sample or marker: additive fingerprints of its calls.

    A call at a place counts as two 64-bit hashes of (place, call), in halves of
    32 bits, and the sums over all places are the fingerprint (up to 2^31 places
    are exact).  The order of places does not matter, null is a call like any
    other, and the sums of blocks of places add up: ``add_parts``."""
    call = F.coalesce(F.col("d").cast("int"), F.lit(-1))
    rows = calls.select(*within, by, *(F.xxhash64(F.lit(k), F.col(along), call).alias(f"h{k}") for k in (0, 1)))
    halves = [half(F.col(f"h{k}")) for k in (0, 1) for half in (lambda h: F.shiftrightunsigned(h, 32), lambda h: h.bitwiseAND(F.lit((1 << 32) - 1)))]
    return rows.groupBy(*within, by).agg(F.count("*").alias("places"), *(F.sum(h).alias(f"f{k}") for k, h in enumerate(halves)))


def add_parts(parts: DataFrame, by: str, within: tuple[str, ...] = ()) -> DataFrame:
    """The parts of whole rows from those of disjoint blocks of places."""
    return parts.groupBy(*within, by).agg(*(F.sum(c).alias(c) for c in ("places", "f0", "f1", "f2", "f3")))


def fingerprints(calls: DataFrame, by: str, along: str, within: tuple[str, ...] = ()) -> DataFrame:
    """One text of ``fingerprint_parts``."""
    text = F.concat_ws("-", *(F.lower(F.hex(c)) for c in ("places", "f0", "f1", "f2", "f3")))
    return fingerprint_parts(calls, by, along, within).select(*within, by, text.alias("fingerprint"))


def first_of_identical(calls: DataFrame, by: str, along: str, within: tuple[str, ...] = ()) -> DataFrame:
    """``by``, first (the smallest one with the same calls) and size of its set.

    Sets of equal fingerprints are compared call by call with their first one;
    a set that fails (no pair of 256-bit fingerprints is known to) is an error."""
    prints = fingerprints(calls, by, along, within)
    sets = prints.groupBy(*within, "fingerprint").agg(F.min(by).alias("first"), F.count("*").alias("size"))
    found = prints.join(sets, [*within, "fingerprint"]).select(*within, by, "first", "size")
    copies = calls.join(found.where(f"{by} <> first").select(*within, by, "first"), [*within, by])
    firsts = calls.join(sets.where("size > 1").select(*within, F.col("first").alias(by)), [*within, by], "left_semi").select(*within, F.col(by).alias("first"), along, F.col("d").alias("same"))
    wrong = copies.join(firsts, [*within, "first", along], "left").groupBy(*within, by).agg(F.count_if(~F.col("d").eqNullSafe(F.col("same"))).alias("wrong"))
    ok = F.when(F.coalesce("wrong", F.lit(0)) > 0, F.raise_error(F.lit("equal fingerprints of different calls"))).otherwise(F.col("first"))
    return found.join(wrong, [*within, by], "left").select(*within, by, ok.cast(prints.schema[by].dataType).alias("first"), "size")


def duplicated_rows(calls: DataFrame, by: str = "i", along: str = "j", within: tuple[str, ...] = ()) -> DataFrame:
    """duplicated: rows beyond the first of each set of identical ones."""
    return first_of_identical(calls, by, along, within).groupBy(*within).agg(F.count_if(F.col("first") != F.col(by)).alias("duplicated"))


def identical_pairs(calls: DataFrame, by: str = "j", along: str = "i", within: tuple[str, ...] = ()) -> DataFrame:
    """pairs of identical columns, counted from the sizes of sets, never listed."""
    sets = first_of_identical(calls, by, along, within).where(F.col("first") == F.col(by))
    return sets.groupBy(*within).agg(F.coalesce(F.sum((F.col("size") * (F.col("size") - 1) / 2).cast("long")), F.lit(0)).cast("long").alias("pairs"))


def assert_hard_calls(calls: DataFrame, complete: bool = True) -> DataFrame:
    """Calls must be 0, 1 or 2; nulls only where ``complete`` is false."""
    ok = F.col("d").isin(0, 1, 2)
    return hold(calls, hard_calls=ok if complete else ok | F.col("d").isNull())


def wide_markers(calls: DataFrame) -> DataFrame:
    """(block-free) storage form: one row a marker with its calls in sample order."""
    return calls.groupBy("j").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "d"))), lambda s: s["d"]).alias("calls"))


def long_calls(markers: DataFrame) -> DataFrame:
    """The long form of one row a marker."""
    return markers.select(F.posexplode("calls").alias("i", "d"), "j").select("i", "j", "d")


def imputation_changes(raw: DataFrame, imputed: DataFrame) -> DataFrame:
    """changed: observed calls that imputation altered (0 is required)."""
    both = raw.where("d is not null").select("i", "j", F.col("d").alias("was")).join(imputed.select("i", "j", F.col("d").alias("now")), ["i", "j"], "left")
    return both.agg(F.count_if(~F.col("was").eqNullSafe(F.col("now"))).alias("changed"))
