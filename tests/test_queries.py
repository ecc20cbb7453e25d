"""Every registered query that has a SQL counterpart gives the same rows as it."""

import pytest

import __spark_entry__ as entry
from compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
#: The training-data queries have tests of their own.
NAMES = [name for name in entry.queries() if name != "pipeline" and not (name.startswith("op") and name[2].isdigit())]


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, connection, name):
    rows = entry.queries()[name](spark, SF_DIR).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
    else:
        assert difference(rows, connection.sql(sql).df()) is None


@pytest.mark.parametrize("name", ["vendor_lookalikes", "rule_lookalike", "flags_long", "reasons", "rule_report"])
def test_query_with_many_vendors(spark, name):
    """Ties between vendors first come up with a hundred of them."""
    larger = "/root/testdata/sf0.01"
    rows = entry.queries()[name](spark, larger).toPandas()
    assert difference(rows, duck(larger).sql(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].risk_level == "High"
