"""Iterated eigenvalues, and the figures of the given panel, against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.functions import PanelError
from panelweave.operators import agreement, genotype, kinship, linkage, spectra, validation
from panelweave.plans.views import markers, panel


@pytest.fixture(scope="module")
def calls(spark, sf):
    return panel(spark, sf).select("i", "j", "d", "label").cache()


@pytest.fixture(scope="module")
def matrix(calls):
    rows = calls.select("i", "j", "d").toArrow()
    x = np.zeros((500, 64))
    x[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["d"].to_numpy()
    return x


def test_iterated_eigenvalues_have_small_residuals(calls, matrix):
    ids, mean, size = spectra._marker_scales(calls)
    values, vectors = spectra.leading(calls, 5, mean, size)
    r = np.corrcoef(matrix.T)
    assert np.allclose(values, np.linalg.eigvalsh(r)[::-1][:5], atol=1e-9)
    assert np.linalg.norm(r @ vectors - vectors * values, axis=0).max() < 1e-8


def test_iteration_that_does_not_converge_says_so(calls, monkeypatch):
    monkeypatch.setattr(spectra, "PASSES", 8)
    ids, mean, size = spectra._marker_scales(calls)
    with pytest.raises(PanelError, match="not converged after 7 passes"):
        spectra.leading(calls, 5, mean, size)


def test_metrics_of_a_panel_over_the_bound(calls, matrix, monkeypatch):
    want = spectra.eigen_metrics(calls)
    monkeypatch.setattr(spectra, "MAX_SIDE", 8)
    assert np.allclose(spectra.eigen_metrics(calls), want, rtol=1e-8)
    r = np.corrcoef(matrix.T)
    assert np.allclose(want, (64 * 64 / (r**2).sum(), np.linalg.eigvalsh(r)[-1]), rtol=1e-9)


@pytest.mark.parametrize("shape", [(12, 5), (5, 12)])
def test_a_missing_call_is_refused_in_either_space(spark, shape):
    n, m = shape
    rows = [(i, j, None if (i, j) == (1, 1) else (i * 7 + j * j) % 3) for i in range(n) for j in range(m)]
    df = spark.createDataFrame(rows, "i int, j int, d int")
    for f in (spectra.eigen_metrics, spectra.pca_reference):
        with pytest.raises(PanelError, match="hard_calls"):
            f(df)


def test_displacement_of_the_given_panel(calls, matrix):
    """Fit on the even populations, displace the odd ones, as NumPy does."""
    label = np.zeros(500, int)
    people = calls.select("i", "label").distinct().toArrow()
    label[people["i"].to_numpy()] = people["label"].to_numpy()
    got = spectra.pca_displacement(calls.where("label % 2 = 1"), calls.where("label % 2 = 0"), 5).first()
    ref, other = matrix[label % 2 == 0], matrix[label % 2 == 1]
    mean, sd = ref.mean(axis=0), ref.std(axis=0, ddof=1)
    _, _, v = np.linalg.svd((ref - mean) / sd, full_matrices=False)
    a, b = (ref - mean) / sd @ v[:5].T, (other - mean) / sd @ v[:5].T
    z = (b.mean(axis=0) - a.mean(axis=0)) / a.std(axis=0, ddof=1)
    ratio = b.var(axis=0, ddof=1) / a.var(axis=0, ddof=1)
    assert np.allclose([got.rms_z, got.max_abs_z, got.median_variance_ratio], [np.sqrt((z**2).mean()), np.abs(z).max(), np.median(ratio)], rtol=1e-6)


def test_replicates_of_many_samples_take_one_pass(spark, monkeypatch):
    """Their matrices are in marker space; before, each replicate was run by itself."""
    monkeypatch.setattr(spectra, "MAX_SIDE", 100)
    rng = np.random.default_rng(8)
    g = rng.integers(0, 3, (3, 70, 20))
    g[1, :, 4] = 2  # does not vary
    rows = [(r, i, j, int(g[r, i, j])) for r in range(3) for i in range(70) for j in range(20)]
    calls = spark.createDataFrame(rows, "replicate int, i int, j int, d int")
    want = {r: spectra.eigen_metrics(calls.where(F.col("replicate") == r)) for r in (1, 2)}
    monkeypatch.setattr(spectra, "eigen_metrics", None)
    got = spectra.eigen_metrics_by(calls, {0: 0, 1: 1, 2: 0}, 20)
    assert sorted(got) == [0, 1, 2] and all(np.allclose(got[r], want[r], rtol=1e-10) for r in want)


def test_projection_keeps_a_row_a_call(spark):
    """Components are sums of one aggregate; before, each call was unfolded into all of them."""
    d = np.random.default_rng(5).integers(0, 3, (30, 12))
    calls = spark.createDataFrame([(i, j, int(d[i, j])) for i in range(30) for j in range(12)], "i int, j int, d int")
    got = spectra.project(calls, spectra.pca_reference(calls, 3))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan.split("Generate")[0] and got.count() == 90
