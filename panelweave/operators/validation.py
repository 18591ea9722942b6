"""The validation of a synthetic panel: metric vectors of replicates, their
ratios to the reference's, the summary row and the gates on it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import distance_bin, ratio
from ..functions.columns import DISTANCE_BINS
from . import agreement, complete, gates, genotype, integrity, kinship, linkage, sampling, spectra

# fixed values: the column name of each distance bin
BIN_NAMES = dict(zip(DISTANCE_BINS, ("0_10kb", "10_50kb", "50_100kb", "100_500kb", "500kb_1Mb", "over_1Mb")))


def _beside(rows: list[DataFrame]) -> DataFrame:
    """One-row tables side by side."""
    return reduce(lambda a, b: a.join(b), rows)


def _by_replicate(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """Tables of a row a replicate, side by side.  They are computed one after
    the other: what reaches the driver is a few figures a replicate."""
    rows: dict[int, dict] = {}
    schema = StructType([StructField("replicate", IntegerType())])
    for p in parts:
        for f in p.schema.fields:
            if f.name != "replicate":
                schema.add(f.name, f.dataType)
        for r in p.collect():
            rows.setdefault(r["replicate"], {}).update(r.asDict())
    return spark.createDataFrame([tuple(rows[r].get(c) for c in schema.names) for r in sorted(rows)], schema)


#: Replicates are numbered from 0; these stand for a reference and for a whole panel beside them.
REFERENCE, WHOLE = -1, -2
FIGURES = ", ".join([
    "replicate int, mean_maf double, median_maf double, monomorphic_markers long, maf_correlation_with_full_reference double, mean_maf_absolute_difference double, median_maf_absolute_difference double",
    "max_maf_absolute_difference double, genotype_missingness double, heterozygosity double, median_ld_score double, effective_rank double, largest_eigenvalue double, duplicated_individuals long",
    "identical_genotype_marker_pairs long, kinship_pairs long, kinship_median double, kinship_q95 double, kinship_max double, duplicate_MZ_pairs long, first_degree_pairs long, second_degree_pairs long",
    *(f"pairs_{n} long, mean_r2_{n} double, median_r2_{n} double" for n in BIN_NAMES.values()),
])
PCA_FIGURES = ", pca_centroid_rms_z double, pca_centroid_max_abs_z double, pca_variance_ratio_median double"
_MAF = {"correlation": "maf_correlation_with_full_reference", "mean_abs_difference": "mean_maf_absolute_difference", "median_abs_difference": "median_maf_absolute_difference", "max_abs_difference": "max_maf_absolute_difference"}
_KIN = {"pairs": "kinship_pairs", "median": "kinship_median", "q95": "kinship_q95", "max": "kinship_max", "mz_pairs": "duplicate_MZ_pairs"}


def _mafs(spark: SparkSession, found: dict[int, complete.Products]) -> DataFrame:
    """replicate, j and maf: a row a marker."""
    return spark.createDataFrame([(r, j, x) for r, p in found.items() for j, x in enumerate(p.maf.tolist())], "replicate int, j int, maf double").coalesce(1)


def _figures(found: dict[int, complete.Products], rows: dict[str, dict[int, dict]], spots: list, fit: tuple | None, window: int) -> list[dict]:
    """A dict of metrics of each replicate, in order; ``rows`` has what was counted over samples."""
    out = []
    for r, p in sorted(found.items()):
        maf, kin = rows["maf"].get(r, {}), rows["king"].get(r, {})
        score, bins = complete.linkage(p, spots, window)
        rank, top = complete.eigen(p)
        own = {"replicate": r, "mean_maf": float(p.maf.mean()), "median_maf": float(np.median(p.maf)), "monomorphic_markers": int((p.levels < 2).sum())}
        own |= {name: maf.get(c) for c, name in _MAF.items()} | {"genotype_missingness": 0.0, "heterozygosity": float(p.hets.sum()) / (p.n * len(p.total))}
        own |= {"median_ld_score": score, "effective_rank": rank, "largest_eigenvalue": top, "duplicated_individuals": rows["copies"][r]["duplicated"], "identical_genotype_marker_pairs": complete.equal_markers(p)}
        own |= {_KIN.get(c, c): kin.get(c) for c in ("pairs", "median", "q95", "max", *kinship.CLASS_COUNTS)}
        own |= {f"{c}_{n}": x for n, b in zip(BIN_NAMES.values(), bins) for c, x in zip(("pairs", "mean_r2", "median_r2"), b)}
        if fit is not None:
            own |= dict(zip(("pca_centroid_rms_z", "pca_centroid_max_abs_z", "pca_variance_ratio_median"), complete.displacement(p, fit)))
        out.append(own)
    return out


def _counted(rows: DataFrame, markers: int, maf: DataFrame) -> dict[str, dict[int, dict]]:
    """What is counted over samples, of each replicate: a few figures."""
    parts = {"maf": maf, "copies": complete.copies(rows), "king": complete.king(rows, markers)}
    return {name: {r["replicate"]: r.asDict() for r in p.collect()} for name, p in parts.items()}


def _table(spark: SparkSession, figures: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(f.values()) for f in figures], schema).coalesce(1)


def metrics_by_replicate(calls: DataFrame, markers: DataFrame, reference_maf: DataFrame, pca_reference_calls: DataFrame | None = None, window: int = linkage.WINDOW) -> DataFrame:
    """replicate and its metrics, for panels (replicate, i, j, d) on the same
    markers (j, bp): every statistic is one job over all replicates.

    Samples are numbered from 0 within each replicate.  LD is measured within
    ``window``; the PCA figures come only with a reference.  Complete panels of
    at most as many markers as samples, whose matrices fit the driver, are read
    once (``complete``); others take a job a statistic."""
    spark, every = calls.sparkSession, calls.select("replicate", "i", "j", "d")
    if pca_reference_calls is not None:
        every = every.unionByName(pca_reference_calls.select(F.lit(REFERENCE).alias("replicate"), "i", "j", "d"))
    spots = complete.spots(markers)
    panel = complete.complete(every) if spots else None
    if panel is None:
        return metrics_by_statistic(calls, markers, reference_maf, pca_reference_calls, window)
    found = complete.products(panel)
    fit = complete.axes(found.pop(REFERENCE)) if pca_reference_calls is not None else None
    own = panel.rows.where(F.col("replicate") != REFERENCE)
    rows = _counted(own, panel.markers, agreement.maf_agreement(_mafs(spark, found), reference_maf, ("replicate",)))
    panel.rows.unpersist()
    return _table(spark, _figures(found, rows, spots, fit, window), FIGURES + (PCA_FIGURES if fit else ""))


def metrics_by_statistic(calls: DataFrame, markers: DataFrame, reference_maf: DataFrame, pca_reference_calls: DataFrame | None = None, window: int = linkage.WINDOW) -> DataFrame:
    """``metrics_by_replicate`` of panels of any shape."""
    by, spark = ("replicate",), calls.sparkSession
    calls = genotype.assert_hard_calls(calls).select("replicate", "i", "j", "d").cache()
    stats = genotype.marker_stats(calls, by).cache()
    maf = agreement.maf_agreement(stats, reference_maf, by).select(
        "replicate",
        F.col("correlation").alias("maf_correlation_with_full_reference"),
        F.col("mean_abs_difference").alias("mean_maf_absolute_difference"),
        F.col("median_abs_difference").alias("median_maf_absolute_difference"),
        F.col("max_abs_difference").alias("max_maf_absolute_difference"),
    )
    own = stats.groupBy("replicate").agg(F.avg("maf").alias("mean_maf"), F.median("maf").alias("median_maf"), F.count_if(F.col("levels") < 2).alias("monomorphic_markers"))
    cells = genotype.panel_stats(calls, by).select("replicate", F.col("missingness").alias("genotype_missingness"), "heterozygosity")
    copies = genotype.duplicated_rows(calls, within=by).withColumnRenamed("duplicated", "duplicated_individuals")
    same = genotype.identical_pairs(calls, within=by).withColumnRenamed("pairs", "identical_genotype_marker_pairs")
    sizes = calls.groupBy("replicate").agg(F.max("i").alias("i"), F.max("j").alias("j"), F.count_distinct("j").alias("m")).collect()
    several = len(sizes) > 1
    # a marker's number names its replicate as well, and a tile's sample its run
    width, per = max((r["j"] for r in sizes), default=0) + 1, max((r["i"] for r in sizes), default=0) // kinship.TILE + 1
    replicate = lambda c, each: F.floor(F.col(c) / each).cast("int").alias("replicate")
    placed = calls.withColumn("j", F.col("replicate") * width + F.col("j"))
    numbers = spark.createDataFrame([(r["replicate"],) for r in sizes], "replicate int")
    label = [F.col("replicate").cast("string"), *(F.col(c) for c in markers.columns if c == "chr")]
    spots = markers.join(numbers).select((F.col("replicate") * width + F.col("j")).alias("j"), "bp", F.concat_ws("-", *label).alias("chr"))
    r2 = linkage.window_ld(placed, spots, window).cache()
    score = linkage.ld_scores(r2, spots).select(replicate("j", width), "ld_score").groupBy("replicate").agg(F.median("ld_score").alias("median_ld_score"))
    bins = r2.groupBy(replicate("j1", width), distance_bin(F.col("dist")).alias("bin")).agg(F.count("*").alias("pairs"), F.avg("r2").alias("mean_r2"), F.median("r2").alias("median_r2"))
    pick = lambda c, b: F.max(F.when(F.col("bin") == b, F.col(c)))
    named = lambda c, b, n: (F.coalesce(pick(c, b), F.lit(0).cast("long")) if c == "pairs" else pick(c, b)).alias(f"{c}_{n}")
    ld = numbers.join(bins, "replicate", "left").groupBy("replicate").agg(*(named(c, b, n) for b, n in BIN_NAMES.items() for c in ("pairs", "mean_r2", "median_r2")))
    people = calls.withColumn("i", F.col("replicate") * (per * kinship.TILE) + F.col("i"))
    pairs = kinship.king_values(people, per=per)  # a run is a replicate
    kin = kinship.king_metrics(pairs.withColumn("replicate", F.col("run").cast("int")), by)
    kin = kin.select("replicate", F.col("pairs").alias("kinship_pairs"), F.col("median").alias("kinship_median"), F.col("q95").alias("kinship_q95"), F.col("max").alias("kinship_max"), F.col("mz_pairs").alias("duplicate_MZ_pairs"), "first_degree_pairs", "second_degree_pairs")
    if several:
        constant = {r["replicate"]: r["monomorphic_markers"] for r in own.collect()}
        found = spectra.eigen_metrics_by(calls, constant, sizes[0]["m"])
    else:
        found = {r["replicate"]: spectra.eigen_metrics(calls) for r in sizes}
    eigen = spark.createDataFrame([(r, *x) for r, x in found.items()], "replicate int, effective_rank double, largest_eigenvalue double")
    parts = [own, maf, cells, score, eigen, copies, same, kin, ld]
    if pca_reference_calls is not None:
        parts.append(spectra.pca_displacement(calls, pca_reference_calls, by=by).select("replicate", F.col("rms_z").alias("pca_centroid_rms_z"), F.col("max_abs_z").alias("pca_centroid_max_abs_z"), F.col("median_variance_ratio").alias("pca_variance_ratio_median")))
    out = _by_replicate(spark, parts)
    for kept in (r2, stats, calls):
        kept.unpersist()
    return out


def dataset_metrics(calls: DataFrame, markers: DataFrame, reference_maf: DataFrame, pca_reference_calls: DataFrame | None = None, window: int = linkage.WINDOW) -> DataFrame:
    """One wide row of metrics of a panel (i, j, d) on markers (j, bp).
    ``reference_maf`` has (j, maf)."""
    return metrics_by_replicate(calls.withColumn("replicate", F.lit(0)), markers, reference_maf, pca_reference_calls, window).drop("replicate")


@dataclass
class Validation:
    summary: DataFrame
    gates: DataFrame
    reference_metrics: DataFrame
    synthetic_metrics: DataFrame


def subset_metrics(calls: DataFrame, subsets: DataFrame, markers: DataFrame, reference_maf: DataFrame, pca_reference_calls: DataFrame) -> DataFrame:
    """replicate and the metrics of each subset (replicate, i) of samples."""
    # numbered within a subset, whose size is a parameter
    place = (F.row_number().over(W.partitionBy("replicate").orderBy("i")) - 1).alias("place")
    chosen = calls.join(subsets.select("replicate", "i", place), "i").select("replicate", F.col("place").alias("i"), "j", "d")
    return metrics_by_replicate(chosen, markers, reference_maf, pca_reference_calls)


#: What the summary has of a whole panel and its reference.
_WHOLE = "hard_calls boolean, n_samples long, n_markers long, markers_in_order boolean, heterozygosity double, reference_heterozygosity double, duplicated long, first_degree_rate double, mz_rate double"


def _at_once(synthetic: DataFrame, reference: DataFrame, markers: DataFrame, cells: int, seed: int, replicates: tuple[int, int], subset: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None:
    """The metrics of both panels' subsets, j and maf of the whole synthetic
    panel, and its row of ``_WHOLE``; None if the panels are not complete."""
    spark, (of_reference, of_synthetic) = synthetic.sparkSession, replicates
    spots = complete.spots(markers)
    if not spots:
        return None
    both = complete.samples(reduce(DataFrame.unionByName, (x.select(F.lit(r).alias("replicate"), "i", "j", "d") for x, r in ((synthetic, WHOLE), (reference, REFERENCE))))).cache()
    seen = complete.summed(both)
    m = max((r["most"] for r in seen.values()), default=0)
    sizes = {r: s["n"] for r, s in seen.items()}
    if len(seen) < 2 or any(r["bad"] for r in seen.values()) or not complete.fits(seen, 2 + sum(replicates)) or min(subset, *sizes.values()) < m:
        both.unpersist()
        return None
    ids = lambda r: both.where(F.col("replicate") == r).select("i")
    of = lambda r, *draw: sampling.seeded_subsets(ids(r), "i", subset, *draw).select(F.lit(r).alias("source"), "i", "replicate")
    sets = of(REFERENCE, of_reference, seed).unionByName(of(WHOLE, of_synthetic, seed + 1).withColumn("replicate", F.col("replicate") + of_reference))
    chosen = both.withColumnRenamed("replicate", "source").join(sets, ["source", "i"]).select("replicate", "i", "calls").cache()
    rows = chosen.unionByName(both.select("replicate", "i", "calls"))
    sizes |= {r: min(subset, sizes[REFERENCE if r < of_reference else WHOLE]) for r in range(of_reference + of_synthetic)}
    found = complete.products(complete.Complete(rows, sizes, m))
    own, whole = found.pop(REFERENCE), found.pop(WHOLE)
    maf = lambda p: _mafs(spark, {0: p}).select("j", "maf")
    counted = _counted(rows.where(F.col("replicate") != REFERENCE), m, agreement.maf_agreement(_mafs(spark, found), maf(own), ("replicate",)))
    figures = _figures(found, counted, spots, complete.axes(own), linkage.WINDOW)
    ref = [f for f in figures if f["replicate"] < of_reference]
    syn = [f | {"replicate": f["replicate"] - of_reference} for f in figures[len(ref) :]]
    kin = counted["king"].get(WHOLE, {})
    rate = lambda c: kin[c] / kin["pairs"] if kin.get("pairs") else None
    order = [s["j"] for s in sorted(spots, key=lambda s: (s["bp"], s["j"]))] == list(range(m))
    het = [float(p.hets.sum()) / (p.n * m) for p in (whole, own)]
    row = (whole.n * m == cells, whole.n, m, order, *het, counted["copies"][WHOLE]["duplicated"], rate("first_degree_pairs"), rate("mz_pairs"))
    for kept in (chosen, both):
        kept.unpersist()
    return _table(spark, ref, FIGURES + PCA_FIGURES), _table(spark, syn, FIGURES + PCA_FIGURES), maf(whole), spark.createDataFrame([row], _WHOLE).coalesce(1)


def _by_statistic(synthetic: DataFrame, reference: DataFrame, markers: DataFrame, cells: int, seed: int, replicates: tuple[int, int], subset: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """As ``_at_once``, of panels of any shape."""
    own_maf = genotype.marker_stats(reference).select("j", "maf")
    ids = lambda c: c.select("i").distinct()
    ref_sets = sampling.seeded_subsets(ids(reference), "i", subset, replicates[0], seed)
    syn_sets = sampling.seeded_subsets(ids(synthetic), "i", subset, replicates[1], seed + 1)
    ref = subset_metrics(reference, ref_sets, markers, own_maf, reference)
    syn = subset_metrics(synthetic, syn_sets, markers, own_maf, reference)
    king = kinship.king_metrics(kinship.king_values(synthetic)).select(ratio(F.col("first_degree_pairs"), F.col("pairs")).alias("first_degree_rate"), ratio(F.col("mz_pairs"), F.col("pairs")).alias("mz_rate"))
    het = [genotype.panel_stats(x).select(F.col("heterozygosity").alias(n)) for x, n in ((synthetic, "heterozygosity"), (reference, "reference_heterozygosity"))]
    shape = synthetic.agg(F.bool_and(F.coalesce(F.col("d").isin(0, 1, 2), F.lit(False))).alias("hard_calls"), F.count_distinct("i").alias("n_samples"), F.count_distinct("j").alias("n_markers"), (F.count("*") == cells).alias("complete"))
    shape = shape.select((F.col("hard_calls") & F.col("complete")).alias("hard_calls"), "n_samples", "n_markers")
    # the same markers, in the order of their positions
    place = lambda rows, *by: rows.select("j", F.row_number().over(W.orderBy(*by)).alias("place"))
    order = integrity.ordered_identity(place(synthetic.select("j").distinct(), "j"), place(markers, "bp", "j"), "place").select(F.col("identical").alias("markers_in_order"))
    return ref, syn, genotype.marker_stats(synthetic).select("j", "maf"), _beside([shape, order, *het, genotype.duplicated_rows(synthetic), king])


def validate_panel(
    ancestry: str, synthetic: DataFrame, reference: DataFrame, markers: DataFrame, full_reference_maf: DataFrame, n_samples: int, n_markers: int, seed: int,
    reference_replicates: int = 20, synthetic_replicates: int = 5, subset: int = 200, round_trip: bool = True,
) -> Validation:
    """Judge a synthetic panel against its reference.

    Matched random subsets of both give metric vectors; the synthetic ones are
    divided by the mean of the reference's.  Close pairs of the whole panel are
    compared with the 97.5 % quantile of the reference subsets' rates.  Complete
    panels, as in ``metrics_by_replicate``, are read once with all their subsets.
    """
    given = synthetic, reference, markers, n_samples * n_markers, seed, (reference_replicates, synthetic_replicates), subset
    ref, syn, own_maf, whole = _at_once(*given) or _by_statistic(*given)
    names = {f"mean_r2_{n}": f"ld_ratio_{n}" for n in ("0_10kb", "10_50kb", "50_100kb")} | {"median_ld_score": "ld_score_ratio", "effective_rank": "effective_rank_ratio", "largest_eigenvalue": "largest_eigenvalue_ratio"}
    base = ref.agg(*(F.avg(m).alias(f"base_{m}") for m in names))
    ratios = syn.join(base).agg(*(F.array_sort(F.collect_list(F.coalesce(ratio(F.col(m), F.col(f"base_{m}")), F.lit(float("nan"))))).alias(n) for m, n in names.items()), F.array_sort(F.collect_list("pca_centroid_rms_z")).alias("pca_rms_z"))
    rates = ref.select((F.col("first_degree_pairs") / F.col("kinship_pairs")).alias("f"), (F.col("duplicate_MZ_pairs") / F.col("kinship_pairs")).alias("m"))
    limits = rates.agg(F.percentile("f", F.lit(0.975)).alias("first_degree_limit"), F.percentile("m", F.lit(0.975)).alias("mz_limit"))
    maf = agreement.maf_agreement(own_maf, full_reference_maf).select(F.col("correlation").alias("maf_correlation"), F.col("abs_difference_of_means").alias("mean_maf_difference"))
    expected = [F.lit(n_samples).alias("expected_samples"), F.lit(n_markers).alias("expected_markers")]
    het = F.abs(F.col("heterozygosity") - F.col("reference_heterozygosity")).alias("heterozygosity_difference")
    columns = ["hard_calls", "n_samples", "n_markers", *expected, "markers_in_order", *maf.columns, "heterozygosity", "reference_heterozygosity", het, *ratios.columns, "duplicated", "first_degree_rate", "mz_rate", *limits.columns]
    summary = _beside([whole, maf, ratios, limits]).select(F.lit(ancestry).alias("ancestry"), *columns, F.lit(round_trip).alias("round_trip")).cache()
    return Validation(summary, gates.evaluate(summary), ref, syn)
