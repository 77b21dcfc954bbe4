"""Every registered query of the core library against its SQL."""

import pytest

from strandline.plans import queries as core

from .compare import assert_same, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query(spark, con, name):
    df = core.QUERIES[name](spark, SF)
    if name in core.ORACLES:
        assert_same(df, con, core.ORACLES[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
