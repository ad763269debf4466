"""Every registered query against its SQL, on all rows of the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from playlens.catalog.oracles import ORACLES as SQL
from playlens.catalog.queries import QUERIES

ROWS_ONLY = {
    "s14_audit_columns", "a06_gold_approx_distinct", "x24_processing_stamps", "x25_to_json", "r27_storage_report",
    "r43_detailed_sample", "c11_count_time",
}


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


def test_every_query_is_checked():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, db, name):
    assert differences(QUERIES[name](spark, folder), db, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_runs(spark, folder, name):
    frame = QUERIES[name](spark, folder)
    assert frame.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_approximate_content_count_is_close(spark, folder):
    approx = QUERIES["a06_gold_approx_distinct"](spark, folder)
    exact = QUERIES["a01_gold_viewer_qos"](spark, folder)
    key = ["customerId", "clientId", "eventDate"]
    both = approx.select(*key, approx.unique_content_count.alias("a")).join(exact, key)
    assert both.filter("abs(a - unique_content_count) > 1").count() == 0
    assert approx.count() == exact.count()
