from __future__ import annotations

from pyspark.sql import functions as F

from legwise.operators import clean
from legwise.staging import stage
from tests.conftest import rows_of

RESULT = "series string, edition int, row_no bigint, times string, gap string"


def test_untimed_editions_keep_text_but_no_seconds(spark):
    rows = [
        ("men", 1907, 0, "47h 00' 00''", "-"),
        ("men", 1907, 1, "66h 00' 00''", "+ 19h 00' 00''"),
        ("men", 1905, 0, "1h 00' 00''", None),
        ("men", 2026, 0, "73h 56' 26''", "-"),
        ("men", 2026, 1, "74h 00' 00''", "51h 00' 00''"),
    ]
    legs = spark.createDataFrame([("men", 1907), ("men", 2026), ("men", 2026)], "series string, edition int")
    cleaned = clean.clean_results(spark.createDataFrame(rows, RESULT), legs)
    got = rows_of(cleaned, "edition", "row_no", "times", "result_type", "total_seconds", "gap_seconds", "leg_count")
    assert got == sorted(
        [
            (1907, 0, "47h 00' 00''", "points", 0, 0, 1),
            (1907, 1, "66h 00' 00''", "points", 0, 0, 1),
            (1905, 0, "1h 00' 00''", "no-results", 0, 0, 0),
            (2026, 0, "73h 56' 26''", "time", 266186, 0, 2),
            (2026, 1, "74h 00' 00''", "time", 266400, 0, 2),
        ],
        key=repr,
    )


def test_missing_text_columns_count_as_zero(spark):
    df = spark.createDataFrame([(1,)], "row_no int")
    assert rows_of(clean.with_seconds(df), "total_seconds", "gap_seconds") == [(0, 0)]


def test_rebase_from_leader(spark):
    rows = [
        ("men", 1997, 0, 100, 7), ("men", 1997, 1, 999, 5), ("men", 1997, 2, 0, 0),
        ("men", 2006, 3, 50, 0), ("men", 2006, 4, 0, 9), ("men", 2005, 0, 10, 0), ("men", 2005, 1, 3, 4),
        ("women", 1997, 9, 70, 1), ("women", 1997, 10, 0, 1),
    ]
    df = spark.createDataFrame(rows, "series string, edition int, row_no int, total_seconds bigint, gap_seconds bigint")
    got = rows_of(clean.rebase_from_leader(df, ["row_no"]), "series", "edition", "row_no", "total_seconds")
    assert got == sorted(
        [
            ("men", 1997, 0, 100), ("men", 1997, 1, 105), ("men", 1997, 2, 100), ("men", 2006, 3, 50),
            ("men", 2006, 4, 59), ("men", 2005, 0, 10), ("men", 2005, 1, 3), ("women", 1997, 9, 70),
            ("women", 1997, 10, 71),
        ],
        key=repr,
    )


def test_overrides_apply_to_zero_only(spark):
    df = spark.createDataFrame(
        [("women", 2025, 0), ("women", 2024, 0), ("men", 2025, 0)], "series string, edition int, distance int"
    ).union(spark.createDataFrame([("women", 2025, 5)], "series string, edition int, distance int"))
    got = rows_of(clean.apply_overrides(df, "distance", clean.distance_overrides(df)), "series", "edition", "distance")
    assert got == [("men", 2025, 0), ("women", 2024, 0), ("women", 2025, 1169), ("women", 2025, 5)]


def test_overrides_do_not_move_the_rows(spark):
    """Rows may carry a page each; a list of literal rows must be known to be small before anything is shuffled."""
    df = stage(spark.createDataFrame([("women", 2025, 0, "page")], "series string, edition int, distance int, page string"), "wide")
    joined = clean.apply_overrides(df, "distance", clean.distance_overrides(df))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows_of(joined, "distance", "page") == [(1169, "page")]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, `Last km` string, c string")
    assert clean.drop_empty_columns(df).columns == ["a", "c"]
    assert clean.drop_empty_columns(df, keep=["Last km"]).columns == ["a", "Last km", "c"]
    assert clean.drop_empty_columns(df.limit(0)).columns == []


def test_title_case_columns(spark):
    df = spark.createDataFrame([("A B", "C-D", "EF")], "`Winner of stage` string, `Yellow Jersey` string, other string")
    assert rows_of(clean.title_case_columns(df)) == [("A B", "C-D", "EF")]


def test_pace(spark):
    df = spark.createDataFrame([(100, 3600), (100, 0), (100, -1)], "d int, s bigint")
    got = [r[0] for r in df.select(clean.pace(F.col("d"), F.col("s"))).collect()]
    assert got == [100.0, None, None]
