from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parent.parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from legwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a Column function to a list of values and return the results in order."""

    def run(function, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        answers = rows.select("i", function(F.col("v")).alias("answer")).collect()
        return [row.answer for row in sorted(answers, key=lambda row: row.i)]

    return run


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
