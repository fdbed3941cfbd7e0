"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from rosterline.plans.table_queries import registry
from rosterline.plans.table_sql import SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registry()) == set(SQL)


@pytest.mark.parametrize("name", list(registry()))
def test_query_equals_sql(spark, db, name):
    state, _, _ = compare(spark, db, name, SF)
    assert state == "ok"


def test_entry(spark):
    assert contract.entry(spark).count() == 5
