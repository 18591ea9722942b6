"""Comparisons of a synthetic panel with its reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratio
from . import selection

KEYS = ("ancestry", "source")


def maf_agreement(synthetic: DataFrame, reference: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row: correlation, mean, median and largest absolute difference, and
    the absolute difference of the means (another figure than the mean one).

    Both have (j, maf); markers of both sides count.  A side that does not vary
    has no correlation (null).  With ``by``, a row for each group of the first."""
    both = synthetic.select(*by, "j", F.col("maf").alias("x")).join(reference.select("j", F.col("maf").alias("y")), "j")
    gap = F.abs(F.col("x") - F.col("y"))
    n, x, y = F.count("*").cast("double"), F.sum("x"), F.sum("y")
    xx, yy, xy = F.sum(F.col("x") * F.col("x")), F.sum(F.col("y") * F.col("y")), F.sum(F.col("x") * F.col("y"))
    return both.groupBy(*by).agg(
        F.count("*").alias("markers"),
        F.try_divide(n * xy - x * y, F.sqrt(F.greatest(n * xx - x * x, F.lit(0.0))) * F.sqrt(F.greatest(n * yy - y * y, F.lit(0.0)))).alias("correlation"),
        F.avg(gap).alias("mean_abs_difference"),
        F.median(gap).alias("median_abs_difference"),
        F.max(gap).alias("max_abs_difference"),
        F.abs(F.avg("x") - F.avg("y")).alias("abs_difference_of_means"),
    )


def replicate_ratio(synthetic: DataFrame, reference: DataFrame) -> DataFrame:
    """replicate, metric, ratio: each synthetic replicate's value over the mean
    of the reference replicates; both have (replicate, metric, value)."""
    base = reference.groupBy("metric").agg(F.avg("value").alias("base"))
    return synthetic.join(base, "metric").select("replicate", "metric", ratio(F.col("value"), F.col("base")).alias("ratio"))


def tail_limits(reference: DataFrame, q: float = 0.975) -> DataFrame:
    """metric and limit: a quantile of the reference replicates."""
    rows = selection.keyed(reference, "value", ("metric",))
    return reference.select("metric").distinct().join(selection.quantiles(rows, (q,), ("metric",)), "metric", "left").select("metric", F.col("q")[0].alias("limit"))


def metric_distribution(candidate: DataFrame, reference: DataFrame) -> DataFrame:
    """metric, value, and the reference's n, mean, sd, median, q025, q975 and
    the share of its values at or below the candidate's; nulls are left out."""
    got = reference.where(F.col("value").isNotNull() & ~F.isnan("value")).join(candidate.select("metric", F.col("value").alias("candidate")), "metric")
    return got.groupBy("metric", "candidate").agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.median("value").alias("median"),
        F.percentile("value", F.lit(0.025)).alias("q025"),
        F.percentile("value", F.lit(0.975)).alias("q975"),
        F.avg((F.col("value") <= F.col("candidate")).cast("double")).alias("percentile"),
    )


def relatedness_rollup(subsets: DataFrame, panel: DataFrame | None = None) -> DataFrame:
    """Figures of each ancestry and source over its subsets, and the full
    panel's single row under the source ``full_panel`` (nulls where it has none).

    ``subsets``: ancestry, source, pairs, median, q95, max, mz_pairs,
    first_degree_pairs, second_degree_pairs; ``panel``: the same without source.
    """
    out = subsets.groupBy(*KEYS).agg(
        F.count("*").alias("subsets"),
        F.avg("median").alias("mean_median"),
        F.median("median").alias("median_median"),
        F.median("q95").alias("median_q95"),
        F.percentile("q95", F.lit(0.975)).alias("q975_q95"),
        F.max("max").alias("max"),
        *(F.sum(c).alias(c) for c in ("pairs", "mz_pairs", "first_degree_pairs", "second_degree_pairs")),
    )
    if panel is not None:
        one = panel.select("ancestry", F.lit("full_panel").alias("source"), F.lit(1).cast("long").alias("subsets"), F.col("median").alias("median_median"), F.col("q95").alias("median_q95"), "max", "pairs", "mz_pairs", "first_degree_pairs", "second_degree_pairs")
        out = out.unionByName(one, allowMissingColumns=True)
    return out


def metric_vector(df: DataFrame, replicate: str = "replicate") -> DataFrame:
    """A wide row of metrics a replicate to (replicate, metric, value)."""
    names = [c for c in df.columns if c != replicate]
    return df.select(replicate, *(F.col(c).cast("double").alias(c) for c in names)).unpivot([replicate], names, "metric", "value")
