"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from tests import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert oracle.compare(result, con, sql) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["data_source"] for r in rows} == {"emulator", "real_device"}
    assert sum(r["rows"] for r in rows) == spark.read.parquet(f"{entry.ENTRY_DIR}/customer.parquet").count() + spark.read.parquet(
        f"{entry.ENTRY_DIR}/supplier.parquet"
    ).count()


def test_sql_names_are_registered():
    assert set(entry.oracle_sql()) <= set(entry.queries())
