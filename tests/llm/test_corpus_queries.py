"""The registered corpus queries against their DuckDB counterparts."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from starwash.llm.oracle import ORACLE
from starwash.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(small):
    return compare.connect(small)


def test_all_operators_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, small, duck, name):
    assert compare.differences(QUERIES[name](spark, small), duck, ORACLE[name]) == []
