from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from legwise.operators import normalise
from legwise.plans.jobs import run_all
from legwise.schema import LEGS_ROLES, Role, STANDINGS, STANDINGS_ROLES, having
from legwise.sources import tables
from tests.conftest import rows_of

ENTRIES = [("3", "Quinn", "105.0", "1988", 0), ("12", "Rae", "7.00", "1988", 1), ("1", "Sam", None, "1988", 2), ("4", "Toni", "+31", "1987", 3), ("", "Uli", "2e1", "1988", 4)]
ENTRY_COLUMNS = "Rank string, Rider string, `Rider No.` string, Year string, row_no int"


def test_rows_sort_as_numbers_and_whole_columns_become_integers(spark):
    found = normalise.apply_roles(spark.createDataFrame(ENTRIES, ENTRY_COLUMNS).replace("", None), STANDINGS_ROLES)
    rows = [tuple(r) for r in normalise.ordered(found, STANDINGS_ROLES, ["row_no"]).drop("row_no").collect()]
    assert rows == [(4, "Toni", 31, 1987), (1, "Sam", None, 1988), (3, "Quinn", 105, 1988), (12, "Rae", 7, 1988), (None, "Uli", 20, 1988)]
    again = normalise.apply_roles(found, STANDINGS_ROLES)
    assert again.schema == found.schema and rows_of(again) == rows_of(found)


def test_half_legs_keep_their_fraction(spark):
    legs = spark.createDataFrame(
        [("1971", "7.50", "late"), ("1971", "7.0", "noon"), ("1970", "20", "old"), ("1971", "rest day", "none")],
        "Year string, Stages string, Start string",
    )
    found = normalise.apply_roles(legs, LEGS_ROLES)
    assert [tuple(r) for r in normalise.ordered(found, LEGS_ROLES, ["Start"]).collect()] == [
        (1970, "20", "old"), (1971, "7", "noon"), (1971, "7.5", "late"), (1971, None, "none"),
    ]
    unrelated = spark.createDataFrame([("x",)], "Start string")
    assert rows_of(normalise.apply_roles(unrelated, LEGS_ROLES)) == [("x",)]


def test_whole_numbers_are_exact_or_left_alone(spark):
    cases = [
        (["9007199254740993", "-9223372036854775808"], [9007199254740993, -9223372036854775808]),
        (["1e3", "12.000"], [1000, 12]),
        (["9223372036854775808", "1"], None),
        (["1.5", "2"], None),
        (["abandoned", "2"], None),
        (["1e30", "2"], None),
    ]
    for texts, expected in cases:
        df = spark.createDataFrame([(t,) for t in texts], "Rank string")
        got = normalise.apply_roles(df, {"Rank": Role.WHOLE})
        assert rows_of(got) == sorted([(v,) for v in (texts if expected is None else expected)], key=repr)
    none = spark.createDataFrame([], "Rank string, Year string")
    verdicts = dict(rows_of(normalise.lossless_int_check(none, ["Rank", "Year", "absent"])))
    assert verdicts == {"Rank": True, "Year": True}


def test_numeric_positions(spark):
    df = spark.createDataFrame([("1990", "30", 0), ("1990", "9", 1), ("1990", "out", 2), ("1989", "9", 3), ("1990", "9", 4)], "Year string, Rank string, row_no int")
    roles = {"Year": Role.KEY, "Rank": Role.KEY, "none": Role.KEY}
    got = dict(rows_of(normalise.numeric_positions(df, roles, ["row_no"]), "row_no", "position"))
    assert got == {3: 1, 1: 2, 4: 3, 0: 4, 2: 5}


def test_roles():
    assert having(STANDINGS_ROLES, Role.KEY) == ["Year", "Rank"] and having(LEGS_ROLES, Role.WHOLE) == ["Year"]


def test_scan_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('Year,Rider No.,name\n2024,NA,"a ""b"" c"\n2023,5.0,null\n')
    scanned = tables.scan_csv(spark, str(path))
    assert rows_of(scanned) == [("2023", "5.0", None), ("2024", None, 'a "b" c')]
    typed = tables.typed(scanned.withColumnRenamed("Year", "edition"), STANDINGS)
    assert typed.columns == STANDINGS.names
    assert rows_of(typed, "edition") == [(2023,), (2024,)]


def test_csv_round_trip(spark, tmp_path):
    texts = ['x "y", z', None, "  blanks  ", "two\nlines", "\ttab", "a\r\nb, \"c\""]
    df = spark.createDataFrame(list(enumerate(texts)), "a int, b string").repartition(2)
    tables.export_csv(df, str(tmp_path / "out"))
    got = rows_of(tables.scan_csv(spark, str(tmp_path / "out")))
    assert got == sorted([(str(i), t) for i, t in enumerate(texts)], key=repr)


def test_part_files_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    for number in (99_999, 100_000, 7):
        (tmp_path / f"part-{number:05d}-x.csv").write_text(f"v\n{number}\n")
    scanned = tables.scan_csv(spark, str(tmp_path), with_order=True)
    assert [r.v for r in scanned.orderBy(*tables.SOURCE_ORDER).collect()] == ["7", "99999", "100000"]


def test_written_rows_have_nulls_last(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 2), ("a", 1, 1)], "series string, edition int, rank int")
    tables.write_table(df, str(tmp_path / "t"), sort_by=["rank"])
    file = next((tmp_path / "t").rglob("*.parquet"))
    import pyarrow.parquet as pq

    assert pq.read_table(file, partitioning=None).column("rank").to_pylist() == [1, 2, None]


def test_missing_table(spark, tmp_path):
    empty = tables.scan_table(spark, str(tmp_path / "none"), STANDINGS)
    assert empty.columns == STANDINGS.names and empty.isEmpty()
    with pytest.raises(FileNotFoundError):
        tables.scan_table(spark, str(tmp_path / "none"), STANDINGS, required=True)


def test_replace_editions_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "series string, edition int, v int"
    first = spark.createDataFrame([("men", 2023, 1), ("men", 2024, 2), ("women", 2024, 3)], schema)
    tables.write_table(first, path, sort_by=["v"])
    tables.replace_editions(spark.createDataFrame([("men", 2024, 9), ("men", 2025, 8)], schema), path)
    read = tables.scan_table(spark, path, first.schema)
    assert rows_of(read) == [("men", 2023, 1), ("men", 2024, 9), ("men", 2025, 8), ("women", 2024, 3)]
    plan = read.where(F.col("edition") == 2025)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(edition" in plan


def test_run_all_reports_failures_at_the_end():
    done = []

    def broken():
        raise ValueError("x")

    with pytest.raises(RuntimeError, match="men"):
        run_all({"men": broken, "women": lambda: done.append("women")})
    assert done == ["women"]
