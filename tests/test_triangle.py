"""The triangle in pieces: the same values, and a disk that holds a piece a task."""

import os

import numpy as np
import pytest

from panelweave.functions import PanelError
from panelweave.operators import kinship
from panelweave.plans import catalog, file_queries
from panelweave.sources import triangle

from .test_kinship import calls_of, expected


def panel_of(markers, n=23):
    rng = np.random.default_rng(markers)
    g = rng.integers(-1, 3, (n, markers))
    g[4], g[5] = 0, 2  # without a heterozygous call
    return g


@pytest.mark.parametrize("n, most", [(0, 5), (1, 5), (2, 5), (40, 5), (40, 100), (40, 10_000)])
def test_pieces_are_whole_rows(n, most):
    cuts = triangle.row_cuts(n, most)
    rows = np.arange(n)
    sizes = [int(rows[a:b].sum()) for a, b in zip(cuts[:-1], cuts[1:])]
    assert sum(sizes) == n * (n - 1) // 2 and all(np.diff(cuts) > 0)
    assert all(s <= most or b - a == 1 for s, a, b in zip(sizes, cuts[:-1], cuts[1:]))


@pytest.mark.parametrize("markers", [5, 70, 400])
def test_values_of_pieces(spark, tmp_path, monkeypatch, markers):
    """Missing calls, pairs without a heterozygous call, several words; rows that
    meet others in chunks."""
    monkeypatch.setattr(triangle, "CHUNK", 64)
    g = panel_of(markers, 150)
    want, path = expected(g, range(150)), f"{tmp_path}/planes.bin"
    width = triangle._write_planes(calls_of(spark, g), path, 150)
    assert os.path.getsize(path) == 150 * 24 * width
    with open(path, "rb") as file:
        for first, last in ((1, 70), (70, 150)):
            got = triangle._piece(file, first, last, width)
            pairs = [(a, b) for b in range(first, last) for a in range(b)]
            assert np.array_equal(got, np.array([want.get(p, np.nan) for p in pairs], np.float32), equal_nan=True)


def test_counts_of_values_leave_no_piece(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(triangle, "PIECE", 20)
    g = np.random.default_rng(2).integers(0, 3, (23, 70))
    rows = triangle.through_pieces(calls_of(spark, g), 23, str(tmp_path), triangle.value_counts, "value double, pairs long")
    got = {}
    for r in rows.collect():
        got[r.value] = got.get(r.value, 0) + r.pairs
    values, counts = np.unique(np.array(list(expected(g, range(23)).values()), np.float32), return_counts=True)
    assert got == dict(zip(values.astype(float).tolist(), counts.tolist()))
    assert os.listdir(tmp_path) == ["planes.bin"]
    one = kinship.full_panel(rows).first()
    assert (one.pairs, one.max) == (253, values[-1])


def test_samples_that_are_not_there(spark, tmp_path):
    calls = calls_of(spark, np.ones((4, 3), int), [0, 1, 2, 5])
    with pytest.raises(PanelError):
        triangle._write_planes(calls, f"{tmp_path}/p", 4)
    with pytest.raises(PanelError):
        triangle._write_planes(calls.where("i <> 1"), f"{tmp_path}/q", 6)


def test_full_panel_refuses_kinships_that_are_not_finite(spark, tmp_path):
    rows = triangle.through_pieces(calls_of(spark, panel_of(5)), 23, str(tmp_path), triangle.value_counts, "value double, pairs long")
    with pytest.raises(PanelError, match="finite_kinship"):
        kinship.full_panel(rows)


def test_figures_of_rows(spark, tmp_path, monkeypatch):
    """Pairs without a kinship do not count, nor does a row that has none."""
    monkeypatch.setattr(triangle, "PIECE", 20)
    g = panel_of(5)
    g[0], g[1] = 0, 2
    rows = triangle.through_pieces(calls_of(spark, g), 23, str(tmp_path), triangle.row_figures, "i1 int, pairs long, low double, high double").collect()
    want = {}
    for (_, b), x in expected(g, range(23)).items():
        want.setdefault(b, []).append(float(np.float32(x)))
    assert 1 not in want and len(want[4]) < 4
    assert {r.i1: (r.pairs, r.low, r.high) for r in rows} == {b: (len(x), min(x), max(x)) for b, x in want.items()} and len(rows) == len(want)
    assert os.listdir(tmp_path) == ["planes.bin"]


@pytest.mark.parametrize("name", ["full_panel_king", "triangle_round_trip"])
def test_queries_leave_no_triangle(spark, sf, tmp_path, monkeypatch, name):
    """The pairs of the panel are not on the disk at the end, nor all at once before."""
    monkeypatch.setattr(file_queries, "work_folder", lambda spark, name: str(tmp_path))
    assert catalog.QUERIES[name](spark, sf).count() > 0
    assert os.listdir(tmp_path) == ["planes.bin"]
