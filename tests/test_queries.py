import pytest

from commgraph.plans import catalog

from .oracle import compare, connection

SF = "/root/testdata/sf0.001"
VACUOUS = {"ref_F7_J5_whitelist_filter"}  # at this small size


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(name, spark, con):
    df = catalog.queries()[name](spark, SF)
    sql = catalog.oracle_sql().get(name)
    n = compare(df, con, sql) if sql else df.count()
    assert n > 0 or name in VACUOUS
