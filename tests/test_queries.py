"""Every query against its SQL counterpart, run by DuckDB on the same tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from starwash.workload.oracle import ORACLE
from starwash.workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return compare.connect(small)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, duck, name):
    assert compare.differences(QUERIES[name](spark, small), duck, ORACLE[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["product_name", "category", "total_quantity", "total_sales"]
