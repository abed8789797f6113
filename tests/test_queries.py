"""Every query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare

SF = "/root/testdata/sf0.001"


def test_entry_has_rows_and_a_stable_schema(spark):
    one, two = entry.entry(spark), entry.entry(spark)
    assert one.count() > 0 and one.schema == two.schema


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, name):
    result = compare(spark, SF, name)
    assert not result.startswith("FAIL"), result
    assert "WARN" not in result, result
