"""Complete panels: read once, with what other panels get a job a statistic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.functions.checks import PanelError
from panelweave.operators import complete, genotype, validation
from panelweave.plans import catalog


def jobs_of(spark, name, work):
    """Spark jobs that ``work`` takes."""
    spark.sparkContext.setJobGroup(name, name)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def panel_of(spark, replicates=2, n=30, m=12, seed=4):
    x = np.random.default_rng(seed).integers(0, 3, (replicates, n, m))
    x[:, 7], x[:, :, 5], x[0, :, 3] = x[:, 2], x[:, :, 1], 1  # copies of samples and of a marker, one that is constant
    rows = [(r, i, j, int(d)) for (r, i, j), d in np.ndenumerate(x)]
    return spark.createDataFrame(rows, "replicate int, i int, j int, d int")


def markers_of(spark, m=12):
    # gaps wider than a window, and two chromosomes
    return spark.createDataFrame([(j, 3_000 * j + 40_000 * (j // 5), "x" if j < 9 else "y") for j in range(m)], "j int, bp long, chr string")


def same(got, want):
    assert list(got) == list(want)
    for name, x in want.items():
        assert got[name] == (pytest.approx(x, rel=1e-9, abs=1e-9, nan_ok=True) if isinstance(x, float | list) else x), name


@pytest.mark.parametrize("replicates", [1, 2])
def test_metrics_of_complete_panels_are_those_by_statistic(spark, replicates):
    calls, m = panel_of(spark, replicates), markers_of(spark)
    ref = panel_of(spark, 1, 40, seed=5).drop("replicate")
    maf = genotype.marker_stats(ref).select("j", "maf")
    fast = validation.metrics_by_replicate(calls, m, maf, ref, 50_000)
    slow = validation.metrics_by_statistic(calls, m, maf, ref, 50_000)
    assert [f.dataType for f in fast.schema] == [f.dataType for f in slow.schema]
    got, want = ({r.replicate: r.asDict() for r in x.collect()} for x in (fast, slow))
    assert sorted(got) == sorted(want) == list(range(replicates))
    for r in want:
        assert want[r]["duplicated_individuals"] == 1 and want[r]["identical_genotype_marker_pairs"] >= 1
        same(got[r], want[r])
    more = validation.metrics_by_replicate(calls, markers_of(spark, 14), maf, ref, 50_000)
    assert {r.replicate: r.asDict() for r in more.collect()} == got  # markers that the panel lacks do not count


@pytest.mark.parametrize("name", ["dataset_metrics", "dataset_metric_figures"])
def test_a_complete_panel_takes_few_jobs(spark, sf, name):
    assert jobs_of(spark, name, lambda: catalog.QUERIES[name](spark, sf).collect()) <= 30


def test_panels_with_gaps_are_no_complete_ones(spark):
    calls = panel_of(spark)
    assert complete.complete(calls).sizes == {0: 30, 1: 30}
    assert complete.complete(calls.where("i > 0 or j > 0")) is None  # a call is missing
    assert complete.complete(calls.where("j <> 4")) is None  # a number is missing
    assert complete.complete(calls.where("i < 5")) is None  # more markers than samples
    assert complete.complete(calls.withColumn("j", F.when(F.col("j") == 4, 3).otherwise(F.col("j")))) is None
    with pytest.raises(PanelError, match="2 rows break hard_calls"):
        complete.complete(calls.withColumn("d", F.when((F.col("i") == 1) & (F.col("j") == 1), None).otherwise(F.col("d"))))
    assert complete.spots(markers_of(spark).withColumn("j", F.lit(1))) is None


def test_validation_at_once_is_that_by_statistic(spark, monkeypatch):
    syn, ref = (panel_of(spark, 1, n, seed=n).drop("replicate") for n in (40, 50))
    m = markers_of(spark)
    maf = genotype.marker_stats(ref).select("j", "maf")
    given = ("x", syn, ref, m, maf, 40, 12, 3, 3, 2, 20)
    fast = validation.validate_panel(*given)
    monkeypatch.setattr(validation, "_at_once", lambda *a: None)
    slow = validation.validate_panel(*given)
    for part in ("summary", "reference_metrics", "synthetic_metrics", "gates"):
        got, want = getattr(fast, part), getattr(slow, part)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        key = lambda r: str(r[1] if part == "gates" else r[0])
        for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
            same(a.asDict(), b.asDict())


def test_gates_of_complete_panels_take_few_jobs(spark, sf):
    assert jobs_of(spark, "gates", lambda: catalog.QUERIES["validation_gates"](spark, sf).collect()) <= 60
