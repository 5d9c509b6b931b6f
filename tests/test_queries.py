"""Every query, streams too, against DuckDB over the smallest tables."""

import pytest

from checks import compare, registry

from conftest import DATA

SQL = registry.oracle_sql()

NAMES = list(registry.ENTRIES)


@pytest.fixture(scope="module")
def tables():
    return compare.open_tables(DATA)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    assert compare.differences(spark, tables, DATA, name, registry.queries()[name], SQL[name]) is None
    assert tables.execute(SQL[name]).fetchone() is not None


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as driver
    rows = driver.entry(spark)
    assert rows.columns == ["stt", "edt", "source_id", "source_name", "order_count", "user_count", "final_amount"]
    assert rows.count() > 0
