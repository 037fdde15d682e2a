"""Every registered query against its SQL counterpart on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as registry
import check_oracles
from orderflow.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="supplied tables are absent")


@pytest.fixture(scope="module")
def connection():
    return check_oracles.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, connection, name):
    same, text = check_oracles.compare(spark, connection, SF_DIR, name)
    assert same, text


def test_every_query_has_sql():
    assert set(all_queries()) <= set(registry.oracle_sql()) <= set(registry.queries())
    assert set(all_queries()) <= set(registry.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    result = registry.entry(spark)
    assert result.columns == [
        "order_date", "country", "category", "total_orders", "unique_customers", "revenue",
    ]
    assert result.count() > 0
