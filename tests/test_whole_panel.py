"""Queries without SQL take the whole table."""

import os

import numpy as np
import pytest

from panelweave.plans import catalog
from panelweave.plans.views import panel


def test_largest_eigenvalue_of_all_samples(spark, sf):
    rows = panel(spark, sf).toPandas()
    x = rows.pivot(index="i", columns="j", values="d").to_numpy(float)
    values = np.linalg.eigvalsh(np.corrcoef(x.T))
    rank, top = catalog.QUERIES["largest_eigenvalue"](spark, sf).first()
    assert top == pytest.approx(values.max(), abs=1e-5)
    assert rank == pytest.approx(64**2 / (values**2).sum(), abs=1e-5)


def test_manifest_lists_every_file(spark, sf):
    want = {f: os.path.getsize(f"{sf}/{f}") for f in os.listdir(sf)}
    got = {r.file: r.bytes for r in catalog.QUERIES["file_manifest"](spark, sf).collect()}
    assert got == want
