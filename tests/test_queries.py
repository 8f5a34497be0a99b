"""Every core query against its SQL on the smallest tables; those without SQL must run."""

import pytest

from quernstone.plans import registry
from tests import oracle


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, sf, duck, name):
    oracle.same(registry.QUERIES[name](spark, sf), duck, registry.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
