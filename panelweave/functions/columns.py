"""Column expressions with the statistical conventions of the data model.

Quantiles interpolate linearly between order statistics, standard deviations
and correlations are those of samples, ratios with a zero denominator are null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: left-closed distance bins, their upper edges in base pairs
DISTANCE_EDGES = (10_000, 50_000, 100_000, 500_000, 1_000_000)
DISTANCE_BINS = ("0-10kb", "10-50kb", "50-100kb", "100-500kb", "500kb-1Mb", ">1Mb")


def distance_bin(bp: Column) -> Column:
    out = F.when(bp.isNull(), F.lit(None).cast("string"))
    for name, edge in zip(DISTANCE_BINS, DISTANCE_EDGES):
        out = out.when(bp < edge, name)
    return out.otherwise(DISTANCE_BINS[-1])


def maf(dosage: Column) -> Column:
    """Minor allele frequency of a group of dosages (an aggregate)."""
    p = F.avg(dosage.cast("double")) / 2
    return F.least(p, 1 - p)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def finite(x: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def percentile(x: Column, q: float) -> Column:
    return F.percentile(x, F.lit(q))


def half_even_index(i: Column, n: Column, k: Column) -> Column:
    """The i-th (from 0) of k evenly spaced places 1..n, rounded half to even."""
    step = F.when(k > 1, (n - 1).cast("double") / (k - 1).cast("double")).otherwise(F.lit(0.0))
    return F.bround(1 + i.cast("double") * step).cast("long")


def squared_correlation(n: Column, x: Column, y: Column, xx: Column, yy: Column, xy: Column) -> Column:
    """r squared from plain sums; 0 where a side does not vary."""
    n, x, y, xx, yy, xy = (c.cast("double") for c in (n, x, y, xx, yy, xy))
    cov = n * xy - x * y
    return F.coalesce(F.try_divide(cov * cov, (n * xx - x * x) * (n * yy - y * y)), F.lit(0.0))


def recode(value: Column, codes: dict[str, str]) -> Column:
    """``value`` by a table of codes; a value that has none is an error."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for k, v in codes.items():
        out = out.when(value == k, v)
    return out.otherwise(F.raise_error(F.concat(F.lit("no code for "), value.cast("string"))).cast("string"))


def key_values(**values: Column) -> Column:
    """``k=v;k=v`` text of a row, null as NA, numbers to seven digits."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("NA"))) for k, v in values.items()]
    return F.concat_ws(";", *parts)
