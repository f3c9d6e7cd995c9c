"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = contract.QUERIES, contract.ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["grupo_edad", "grupo_edad_ui"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == ""
