"""Every query against its SQL form on the smallest tables, as ``check_oracle.py`` does on larger ones."""

import pytest

from check_oracle import compare, connect
from __spark_entry__ import entry, oracle_sql, queries
from oreline.plans import load_all

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n in load_all().ORACLES))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, SF, queries()[name], oracle_sql()[name])
    assert ok, message


def test_entry(spark):
    assert entry(spark).columns == ["antecedents", "consequents", "support", "confidence", "lift"]


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
