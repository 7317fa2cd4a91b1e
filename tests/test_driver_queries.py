"""Every query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from driver_queries import QUERIES, SQL
from tests.oracle import difference, tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")

# Each of these repeats a whole build; tests/test_build.py covers them on small feeds.
LONG = {
    "gated_build_ranking", "gated_build_warnings", "stream_build_drop_late", "stream_build_merge_late",
    "stream_build_small_batches", "late_data_drop", "late_data_in_silver", "parity_audit", "upsert_merge",
    "histogram_ranks", "full_refresh_build", "gate_skipped_nodes",
}


@pytest.fixture(scope="module")
def database():
    return tables(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns[:3] == ["region_nom", "carburant_nom", "count_stations"] and not rows.isEmpty()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LONG))
def test_query(spark, database, name):
    assert difference(spark, FOLDER, name, database) == ""
