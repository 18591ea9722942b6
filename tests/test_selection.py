import numpy as np
import pytest
from pyspark.sql import functions as F

from panelweave.operators import kinship, selection
from panelweave.plans.views import panel

QS = (0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0)


def test_keys_sort_as_doubles_and_come_back():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=1000) * 10.0 ** rng.integers(-300, 300, 1000), [0.0, 5e-324, -5e-324, np.inf, -np.inf]])
    assert np.array_equal(np.argsort(selection.sort_key(x), kind="stable"), np.argsort(x, kind="stable"))
    assert np.array_equal(selection.of_key(selection.sort_key(x)), x) and selection.sort_key(-0.0) == selection.sort_key(0.0)


@pytest.mark.parametrize("case", ["many", "ties", "one", "two", "close"])
def test_quantiles_are_those_of_numpy(spark, case):
    rng = np.random.default_rng(2)
    x = {"many": rng.normal(size=5000), "ties": rng.choice([-1.5, 0.0, 2.0], 3000), "one": np.array([3.25]), "two": np.array([-1.0, 4.0]), "close": 1.0 + np.arange(700) * 2.0**-52}[case]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "v double").repartition(5)
    got = selection.quantiles(selection.keyed(df, "v"), QS).collect()
    assert len(got) == 1 and np.allclose(got[0].q, np.quantile(x, QS), rtol=1e-15, atol=0)


def test_groups_nulls_and_no_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{k % 7}" if k % 7 else None, float(v)) for k, v in enumerate(rng.normal(size=2000))]
    df = spark.createDataFrame([*rows, ("none", None)], "g string, v double")
    # a null group has no summary row to join; it is left out of the answer here
    got = {r.g: r.q for r in selection.quantiles(selection.keyed(df.where("g is not null"), "v", ("g",)), QS, ("g",)).collect()}
    assert set(got) == {f"g{k}" for k in range(1, 7)}
    for g, q in got.items():
        assert np.allclose(q, np.quantile([v for h, v in rows if h == g], QS))
    empty = selection.keyed(df.where("false"), "v")
    assert selection.quantiles(empty, QS).count() == 0
    assert selection.with_quantiles(empty.agg(F.count("*").alias("n")), empty, QS).first().q is None


def test_two_thousand_samples_without_a_percentile_buffer(spark):
    """All two million pairs of a panel: the twelve quantiles are NumPy's, and
    nothing in the plan keeps the values of a group together."""
    pairs = kinship.king_pairs(panel(spark, "/root/testdata/sf0.1"), form="tiles").select("kinship")
    kept = selection.keyed(pairs, "kinship")
    assert kept.count() > 1_900_000
    out = selection.quantiles(kept, kinship.QUANTILES)
    x = np.sort(kept.select("kinship").toArrow().column(0).to_numpy())
    assert np.allclose(out.first().q, np.quantile(x, kinship.QUANTILES), rtol=1e-12)
    plan = kinship.king_distribution(pairs)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
    # a round counts buckets of 16 bits: what a task receives is bounded by them
    assert kept.select(F.shiftright("key", 48)).distinct().count() <= 1 << selection.BITS
