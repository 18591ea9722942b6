"""Kinship in blocks of samples: the same pairs whatever the blocks, and
summaries that never list them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelweave.functions import PanelError
from panelweave.operators import kinship, tiles
from panelweave.sources import sinks


def calls_of(spark, g, ids=None):
    ids = range(len(g)) if ids is None else ids
    rows = [(int(i), j, None if d is None or d < 0 else int(d)) for i, row in zip(ids, g) for j, d in enumerate(row)]
    return spark.createDataFrame(rows, "i int, j int, d int")


def expected(g, ids):
    out = {}
    for b in range(len(g)):
        for a in range(len(g)):
            if ids[a] < ids[b]:
                x, y = g[a], g[b]
                den = int((x == 1).sum() + (y == 1).sum())
                if den:
                    opposite = ((x == 0) & (y == 2)) | ((x == 2) & (y == 0))
                    out[ids[a], ids[b]] = float(((x == 1) & (y == 1)).sum() - 2 * int(opposite.sum())) / den
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(tiles, "SAMPLE_TILE", 3)
    monkeypatch.setattr(tiles, "BLOCKS", 4)


@pytest.mark.parametrize("step", [1, 1000, -7])
@pytest.mark.parametrize("markers", [5, 70, 400])
def test_pairs_and_values_over_many_blocks(spark, small_blocks, step, markers):
    """Missing calls, ids with gaps (a block each, before), one word and several."""
    rng = np.random.default_rng(markers)
    g = rng.integers(-1, 3, (23, markers))
    g[4] = 0  # without a heterozygous call
    g[5] = 2
    ids = [step * k for k in range(len(g))]
    want, calls = expected(g, ids), calls_of(spark, g, ids)
    rows = kinship.king_pairs(calls, 2).collect()
    assert len(rows) == len(want) and {(r.i1, r.i2): r.kinship for r in rows} == want
    got = {}
    for r in kinship.king_values(calls).collect():
        got[r.kinship] = got.get(r.kinship, 0) + r.pairs
    values, counts = np.unique(list(want.values()), return_counts=True)
    assert got == dict(zip(values.tolist(), counts.tolist()))


def test_values_of_wide_panels_are_the_same(spark, small_blocks, monkeypatch):
    rng = np.random.default_rng(3)
    calls = calls_of(spark, rng.integers(0, 3, (15, 130)))
    once = sorted((r.kinship, r.pairs) for r in kinship.king_values(calls).groupBy("kinship").agg(F.sum("pairs").alias("pairs")).collect())
    monkeypatch.setattr(tiles, "DENSE", 10)
    assert sorted((r.kinship, r.pairs) for r in kinship.king_values(calls).groupBy("kinship").agg(F.sum("pairs").alias("pairs")).collect()) == once


def test_summaries_of_values_and_of_pairs_agree(spark):
    rng = np.random.default_rng(9)
    g = rng.integers(0, 3, (40, 64))
    g[7] = g[3]
    calls, pairs, values = calls_of(spark, g), kinship.king_pairs(calls_of(spark, g)), kinship.king_values(calls_of(spark, g))
    for f in (kinship.king_metrics, kinship.king_distribution):
        assert f(values).collect() == f(pairs).collect()
    x = np.sort([r.kinship for r in pairs.collect()])
    assert np.allclose([kinship.king_distribution(values).first()[k] for k in range(12)], np.quantile(x, kinship.QUANTILES), rtol=1e-12)
    classes = {r["class"]: r for r in kinship.relatedness_classes(values).collect()}
    assert classes["MZ"].pairs == 1 and classes["MZ"]["mean"] == 0.5
    assert sum(r.pairs for r in classes.values()) == len(x)
    assert kinship.king_metrics(kinship.king_values(calls.where("false"))).first().pairs == 0
    groups = spark.createDataFrame([(i, i % 3 if i else None) for i in range(40)], "i int, label int")
    within = {r.label: r.pairs for r in kinship.king_metrics(kinship.king_values_within(calls, groups, "label"), ("label",)).collect()}
    assert within == {0: 13 * 12 // 2, 1: 13 * 12 // 2, 2: 13 * 12 // 2}


def test_no_pair_is_shuffled(spark):
    """Rows of pairs leave the tasks that found them; before, all were summed by an exchange."""
    calls = calls_of(spark, np.random.default_rng(2).integers(0, 3, (30, 64)))
    for form in ("auto", "tiles"):
        plan = kinship.king_pairs(calls, 64, form)._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan.split("MapInArrow")[0] and "Repartition" not in plan.split("MapInArrow")[0] and "MapInArrow" in plan
    assert kinship.king_values(calls).count() < 30 * 29 // 2


@pytest.mark.parametrize("dealt", [True, False])
def test_triangle_of_blocks(spark, small_blocks, tmp_path, dealt):
    """Pairs as they come; before, all were counted by row and sorted first."""
    g = np.random.default_rng(4).integers(0, 3, (25, 40))
    want, path = expected(g, range(25)), f"{tmp_path}/k.bin"
    pairs = kinship.king_pairs(calls_of(spark, g), 2).withColumnRenamed("kinship", "value")
    sinks.write_triangle(pairs, path, 25, dealt=dealt)
    assert np.fromfile(path, "<f4").tolist() == [np.float32(want[a, b]) for b in range(25) for a in range(b)]


@pytest.mark.parametrize(
    ("pairs", "error"),
    [
        ([(0, 1), (0, 2), (0, 2)], "row 2"),  # a copy in place of a pair
        ([(0, 1), (0, 2)], "row 2"),
        ([(0, 1), (2, 2), (0, 2), (1, 2)], "row 2"),
        ([(0, 2), (1, 2)], "1 rows for 3"),
        ([(0, 1), (0, 2), (1, 2), (0, 3), (1, 3), (2, 3)], "row 3"),
    ],
)
@pytest.mark.parametrize("dealt", [True, False])
def test_a_triangle_with_gaps_is_refused_and_not_left(spark, tmp_path, pairs, error, dealt):
    df = spark.createDataFrame([(a, b, 0.5) for a, b in pairs], "i1 int, i2 int, value double")
    with pytest.raises(PanelError, match=error):
        sinks.write_triangle(df, f"{tmp_path}/k.bin", 3, dealt=dealt)
    assert list(tmp_path.iterdir()) == []


@pytest.mark.parametrize("markers", [64, 500])
def test_kinships_are_rounded_once_each(spark, small_blocks, markers):
    """A rounded pair is what Spark's round gives; before, each row was rounded by Spark."""
    g = np.random.default_rng(6).integers(-1, 3, (21, markers))
    g[3], g[4] = 0, 2
    calls = calls_of(spark, g)
    want = {(r.i1, r.i2): r.kinship for r in kinship.king_pairs(calls, 4).withColumn("kinship", F.round("kinship", 3)).collect()}
    got = kinship.king_pairs(calls, 4, digits=3)
    assert {(r.i1, r.i2): r.kinship for r in got.collect()} == want
    assert ("round" in got._jdf.queryExecution().optimizedPlan().toString()) == (markers > 64)
    x = np.concatenate([tiles._fractions(1, None), [0.125, -0.125, 2.5e-9, -1.5e-8, 1e-12]])
    x = x[x == x]
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select(F.round("x", 8).alias("a"), F.round("x", 2).alias("b")).collect()
    assert [r.a for r in rows] == tiles.half_up(x, 8).tolist() and [r.b for r in rows] == tiles.half_up(x, 2).tolist()


@pytest.mark.parametrize("markers", [64, 400])
def test_strips_of_pairs_stay_small(markers):
    """A core's cache holds the words of a strip; before, a strip had 2^19 pairs."""
    rng, width = np.random.default_rng(1), -(-markers // 64)
    n = 3000
    rows = [{"i": i, "w": w, "h": int(h), "r": 0, "a": 0} for w in range(width) for i, h in enumerate(rng.integers(0, 1 << 62, n))]
    kind = pa.list_(pa.struct([("i", pa.int32()), ("w", pa.int32()), ("h", pa.int64()), ("r", pa.int64()), ("a", pa.int64())]))
    side = pa.array([rows], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([1]), side, side], names=["run", "t1", "t2", "left", "right"])
    sizes = [num.size for _, _, _, num, *_ in tiles._strips(iter([batch]), width, 256)]
    assert sum(sizes) == n * n and 8 * max(sizes) <= 1 << 20
