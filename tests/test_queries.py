"""Every registered query against its reference SQL on the smallest tables."""

import pytest
from oracle import compare, connect, data_dir

import __spark_entry__ as entry_module
from homeload.queries import ORACLES, QUERIES

SF = "0.001"


@pytest.fixture(scope="module")
def con():
    return connect(data_dir(SF))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, data_dir(SF))
    if name not in ORACLES:
        assert df.count() >= 0
        return
    diff, _ = compare(df, con, ORACLES[name])
    assert diff is None


def test_entry_contract(spark):
    assert entry_module.queries().keys() >= entry_module.oracle_sql().keys()
    assert entry_module.entry(spark).count() > 0
