"""Every registered query against its SQL, over whole generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from refinery.plans.catalog import QUERIES
from refinery.plans.oracles import ORACLES
from tests.compare import difference, duckdb_over
from tests.conftest import TABLES


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(TABLES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, TABLES), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
