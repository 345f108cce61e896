"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks import oracle, queries
from checks.compare import compare

from core_records import SMALL


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    result = compare(spark, SMALL, name)
    assert result.startswith("ok" if name in oracle.oracle_sql() else "rows only"), result
    assert not result.endswith("(0)")


def test_every_sql_has_a_query():
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert queries.queries().keys() - oracle.oracle_sql().keys() == set()
    assert queries.queries().keys() <= contract.queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.dtypes == [("year", "int"), ("month", "int"), ("cnt", "bigint")]
    assert df.count() == 79  # one of the 80 months has no valid row
