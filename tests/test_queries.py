"""Every registered query against its SQL on the small tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import duck_result, spark_result

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    names, types, rows = spark_result(QUERIES[name](spark, FOLDER))
    wanted_names, wanted_types, wanted = duck_result(FOLDER, ORACLE[name])
    assert names == wanted_names
    assert [t.replace(" ", "") for t in types] == wanted_types
    assert rows.total() == wanted.total() > 0
    assert rows == wanted


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["name", "department", "total_sales", "total_revenue"]
    assert result.count() == 10


def test_no_view_is_left_behind(spark):
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("src_")]
