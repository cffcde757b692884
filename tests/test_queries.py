"""Every registered query against its SQL."""

import pytest
from tests.compare import as_rows, oracle
from tests.conftest import SF_DIR

import __spark_entry__ as contract


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, name):
    got = contract.queries()[name](spark, SF_DIR).toArrow()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    want = oracle(SF_DIR, sql)
    assert sorted(got.column_names) == sorted(want.column_names)
    assert as_rows(got) == as_rows(want)


def test_entry(spark):
    assert contract.entry(spark).count() == 940
