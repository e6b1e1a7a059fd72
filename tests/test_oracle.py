"""Every query of the catalogue against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from townhall.plans.catalogue import CATALOGUE
from townhall.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(CATALOGUE) == set(ORACLE)
    assert set(CATALOGUE) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query(name, spark, small, con):
    assert difference(CATALOGUE[name](spark, small), con, ORACLE[name]) is None
