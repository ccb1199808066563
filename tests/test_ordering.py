"""Order-dependent operators against plain Python, with one group holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from legwise.operators.ordering import (
    CHUNK,
    carry_forward,
    first_k,
    first_value_per_group,
    number_rows,
    position_rows,
    range_rows,
)
from tests.conftest import rows_of

SCHEMA = "g string, k int, id int, v int"


@pytest.fixture(scope="module")
def skewed(spark):
    draw = random.Random(7)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 else draw.choice(["a", "b", None])
        rows.append((group, draw.choice([None, *range(40)]), i, draw.choice([None, None, None, i])))
    draw.shuffle(rows)
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(6)


def _grouped(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_number_rows(spark, skewed, partitions):
    rows, df = skewed
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        numbered = rows_of(number_rows(df, ["g"], ["k", "id"], "n"), "g", "id", "n")
        whole = rows_of(number_rows(df, [], ["k", "id"], "n"), "id", "n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = [(g, r[2], n) for g, members in _grouped(rows).items() for n, r in enumerate(members, 1)]
    assert numbered == sorted(expected, key=repr)
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    assert whole == sorted(((r[2], n) for n, r in enumerate(ordered, 1)), key=repr)


def test_hot_group_is_split_over_chunks(spark, skewed):
    _, df = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunked = range_rows(df, ["g"], ["k", "id"], first={"first_id": "id"})
        assert chunked.where(F.col("g") == "hot").select(CHUNK).distinct().count() > 1
        led = position_rows(chunked, ["g"], "n", ["first_id"])
        got = {row.g: row.first_id for row in led.select("g", "first_id").distinct().collect()}
        numbers = sorted(row.n for row in led.where(F.col("g") == "hot").select("n").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows, _ = skewed
    assert got == {g: members[0][2] for g, members in _grouped(rows).items()}
    assert numbers == list(range(1, len(_grouped(rows)["hot"]) + 1))


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_carry_forward(spark, skewed, coalesce):
    rows, df = skewed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = rows_of(carry_forward(df, ["g"], ["k", "id"], "v", "last_v"), "id", "last_v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = []
    for members in _grouped(rows).values():
        last = None
        for row in members:
            last = row[3] if row[3] is not None else last
            expected.append((row[2], last))
    assert got == sorted(expected, key=repr)


def test_first_k_and_first_value(spark, skewed):
    rows, df = skewed
    order = [F.col("k").asc_nulls_last(), F.col("id").asc()]
    got = rows_of(first_k(df, ["g"], order, 2, "n"), "g", "id", "n")
    expected = [(g, r[2], n) for g, m in _grouped(rows).items() for n, r in enumerate(m[:2], 1)]
    assert got == sorted(expected, key=repr)
    first = rows_of(first_value_per_group(df, ["g"], ["k", "id"], ["id", "v"]), "g", "id", "v")
    assert first == sorted(((g, m[0][2], m[0][3]) for g, m in _grouped(rows).items()), key=repr)
