"""Blocks of samples that meet: as many whatever the panel, each sent to a pair once."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelweave.operators import tiles

KIND = pa.list_(pa.struct([("i", pa.int32()), ("w", pa.int32()), ("h", pa.int64()), ("r", pa.int64()), ("a", pa.int64())]))


@pytest.mark.parametrize("step", [1, 7])
def test_blocks_do_not_grow_in_number(spark, monkeypatch, step):
    """Before, a block had at most 8,192 samples: a row went to ever more of them."""
    monkeypatch.setattr(tiles, "BLOCKS", 2)
    planes = spark.range(0, 20_000 * step, step).select(F.col("id").cast("int").alias("i"), F.lit(0).alias("w"), *(F.lit(1).cast("long").alias(c) for c in "hra"))
    met = tiles._block_pairs(planes, F.lit(0), 1)
    found = sorted((r.t1, r.t2, r.left, r.right) for r in met.select("t1", "t2", F.size("left").alias("left"), F.size("right").alias("right")).collect())
    assert [f[:2] for f in found] == [(0, 0), (0, 1), (1, 1)]
    assert found[0][2] + found[2][2] == 20_000 and found[1][2:] == (found[0][2], found[2][2])
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 1 and "Join" not in plan


def batch_of(left, right, same):
    side = lambda ids, h: pa.array([[{"i": int(i), "w": 0, "h": int(x), "r": int(~x & 255), "a": 0} for i, x in zip(ids, h)]], KIND)
    return pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([0 if same else 1]), side(*left), side(*right)], names=["run", "t1", "t2", "left", "right"])


@pytest.mark.parametrize("same", [True, False])
def test_strips_of_large_blocks(same):
    """Columns are cut as well; each pair comes once, with its count."""
    rng, seen = np.random.default_rng(5), {}
    left = (np.arange(50), rng.integers(0, 256, 50))
    right = left if same else (np.arange(50, 83), rng.integers(0, 256, 33))
    for _, i2, i1, num, own2, own1, keep in tiles._strips(iter([batch_of(left, right, same)]), 1, 4, strip=9):
        assert num.size <= 9
        for k, n in zip(*np.nonzero(np.ones(num.shape, bool) if keep is None else keep)):
            assert (pair := (int(i1[n]), int(i2[k]))) not in seen
            seen[pair] = (int(num[k, n]), int(own2[k, 0] + own1[0, n]))
    h = dict(zip(left[0].tolist(), left[1].tolist())) | dict(zip(right[0].tolist(), right[1].tolist()))
    want = {(a, b): ((h[a] & h[b]).bit_count(), h[a].bit_count() + h[b].bit_count()) for a in left[0].tolist() for b in right[0].tolist() if a < b}
    assert seen == want
