"""Every registered query at the smallest scale against its SQL."""

import pytest

import __spark_entry__ as entry_module
from tools.check import compare, connect

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    same, why, _ = compare(QUERIES[name](spark, ROOT), ORACLES[name], duck)
    assert same, why


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_entry_gives_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
