"""Every query over the test tables against its SQL in another engine."""

import pytest

from panelweave.plans import catalog

from .oracle import assert_same, duck


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows(spark, sf, name):
    assert_same(catalog.QUERIES[name](spark, sf), duck(sf).sql(catalog.SQL[name]))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
