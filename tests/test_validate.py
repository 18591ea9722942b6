"""The check of a fileset looks at every call."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave import cli
from panelweave.functions import PanelError
from panelweave.sources import plink

from .test_kinship import calls_of


def fileset(spark, folder, g):
    calls = calls_of(spark, g).withColumn("d", F.col("d").cast("tinyint"))
    bim = spark.range(g.shape[1]).select(F.col("id").cast("int").alias("j"), F.lit("1").alias("chr"), F.concat(F.lit("m"), "id").alias("id"), F.lit(0.0).alias("cm"), (F.col("id") + 1).alias("pos"), F.lit("A").alias("a1"), F.lit("G").alias("a2"))
    fam = plink.default_fam(spark.range(g.shape[0]).select(F.col("id").cast("int").alias("i"), F.concat(F.lit("s"), "id").alias("iid")))
    plink.write_fileset(f"{folder}/p", calls, bim, fam)
    return f"{folder}/p"


@pytest.mark.parametrize(("sample", "marker"), [(1, 0), (100, 2), (99, 1)])
def test_a_call_that_the_decoders_read_apart(spark, tmp_path, monkeypatch, sample, marker):
    """Before, every second of 101 samples was passed over."""
    g = np.random.default_rng(1).integers(-1, 3, (101, 3))
    g[:, 0], g[sample, marker] = 0, 1
    prefix = fileset(spark, tmp_path, g)
    row = cli.validate(spark, prefix).first()
    assert (row.status, row.samples, row.markers) == ("PASS", 101, 3)
    assert np.isclose(row.missingness, (g < 0).mean()) and np.isclose(row.heterozygosity, (g == 1).sum() / (g >= 0).sum())
    right = plink.decode_block
    # a decoder that loses heterozygous calls of one sample
    monkeypatch.setattr(plink, "decode_block", lambda block, n: F.transform(right(block, n), lambda d, k: F.when((k != sample) | (d != 1), d)))
    with pytest.raises(PanelError, match="the decoders differ"):
        cli.validate(spark, prefix)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 40])
def test_pieces_of_both_decoders(spark, tmp_path, n):
    g = np.random.default_rng(n).integers(-1, 3, (n, 5))
    path = f"{fileset(spark, tmp_path, g)}.bed"
    assert plink.decoders_differ(spark, path, n, piece=2).first()[0] == 0
    got = {(r.i, r.j): r.d for r in plink.read_calls_sql(spark, path, n, piece=2).collect()}
    assert got == {(i, j): None if g[i, j] < 0 else g[i, j] for i in range(n) for j in range(5)}
