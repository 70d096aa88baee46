import pytest

from commgraph.llm.queries import QUERIES
from commgraph.llm.sql import ORACLE

from ..oracle import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, con, ORACLE[name]) > 0
    else:
        assert df.count() > 0
