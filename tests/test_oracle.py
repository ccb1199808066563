"""A few queries against DuckDB; ``check_oracle.py`` runs all of them."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import ENTRY_DIR, entry, oracle_sql, queries
from check_oracle import compare, connect
from spark_queries import ORACLE, QUERIES

needs_data = pytest.mark.skipif(not Path(ENTRY_DIR).exists(), reason="no test tables")


def test_every_query_of_the_library_has_its_sql():
    assert set(ORACLE) == set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@needs_data
def test_entry(spark):
    first = entry(spark)
    assert first.columns[:3] == ["series", "edition", "rank"] and not first.isEmpty()


@needs_data
@pytest.mark.parametrize(
    "name",
    ["rebuild_standings", "carry_forward_events", "clean_results", "ranking_rows_by_class", "integrity_missing_rows"],
)
def test_query(spark, name):
    df = queries()[name](spark, ENTRY_DIR)
    assert compare(df, connect(ENTRY_DIR), oracle_sql()[name]) == []
