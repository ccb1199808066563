"""Order of written tables, jobs side by side, and the binned overlap join."""

from __future__ import annotations

import threading
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from legwise.operators import written_order
from legwise.operators.analytics import overlaps
from legwise.plans import jobs
from legwise.sources import tables
from legwise.sources.tables import write_table
from tests.conftest import rows_of

ROWS = [("a", 1, k % 7 if k % 5 else None, f"n{k % 3}") for k in range(200)] + [("b", 2, 1, "x"), (None, 3, 4, "y"), (None, 3, None, None)]
SCHEMA = "series string, edition int, rank int, name string"


def faults(spark, path, order=("rank", "name")):
    schema = spark.createDataFrame([], SCHEMA).schema
    return {(r.series, r.edition): (r.rows, r.faults) for r in written_order.order_faults(spark, str(path), schema, order).collect()}


def test_written_replaced_and_spoilt_tables(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    write_table(df, str(tmp_path), sort_by=["rank", "name"])
    fine = {("a", 1): (200, 0), ("b", 2): (1, 0), (None, 3): (2, 0)}
    assert faults(spark, tmp_path) == fine
    tables.replace_editions(df.where("series = 'a'"), str(tmp_path), sort_by=["rank", "name"])
    spark.catalog.refreshByPath(str(tmp_path))
    assert faults(spark, tmp_path) == fine
    # a file more, named before or after the others: faults at the border only
    (folder,) = tmp_path.glob("series=b/edition=2")
    for name, rank in (("part-zzz.parquet", 0), ("part-00000-.parquet", 2)):
        pq.write_table(pa.table({"rank": pa.array([rank], pa.int32()), "name": ["q"]}), folder / name)
    spark.catalog.refreshByPath(str(tmp_path))
    assert faults(spark, tmp_path)["b", 2] == (3, 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert faults(spark, tmp_path)["a", 1] == (200, 0)
        backwards = df.where("series = 'a' AND rank IS NOT NULL").select("series", "edition", "rank", F.lit("n").alias("name"))
        tables.replace_editions(backwards.withColumn("rank", -F.col("rank")), str(tmp_path), sort_by=["rank"])
        spark.catalog.refreshByPath(str(tmp_path))
        assert faults(spark, tmp_path, ["rank"])["a", 1] == (160, 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_descents():
    ranks, names = pa.array([1, 2, 2, None, None, 1]), pa.array(["b", "a", None, "z", "a", "a"])
    got = written_order._descents([ranks.slice(0, 5), names.slice(0, 5)], [ranks.slice(1), names.slice(1)])
    assert got.tolist() == [False, False, False, True, True]


def test_nothing_is_shuffled_but_a_row_a_split(spark, tmp_path):
    write_table(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path), sort_by=["rank"])
    plan = written_order.order_faults(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema, ["rank"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") :]
    assert "Sort" not in below and "Exchange" not in below


def test_jobs_run_side_by_side(spark):
    meeting = threading.Barrier(2, timeout=60)

    def meets():
        meeting.wait()
        return spark.range(10).count()

    def fails():
        raise ValueError("broken")

    def missing():
        raise jobs.Missing("not there")

    outcomes = jobs.run_side_by_side(spark, {"one": meets, "bad": fails, "none": missing, "two": meets}, at_once=4)
    assert [(o.name, o.outcome, o.result) for o in outcomes] == [("one", "done", 10), ("bad", "failed", None), ("none", "missing", None), ("two", "done", 10)]
    assert rows_of(jobs.outcome_table(spark, outcomes), "name", "message")[0] == ("bad", "ValueError: broken")
    with pytest.raises(RuntimeError, match="failed: bad"):
        jobs.run_all(spark, {"bad": fails, "fine": lambda: 1})
    assert jobs.run_all(spark, {"fine": lambda: 1, "none": missing}) == {"fine": 1, "none": False}


def test_a_failure_cancels_the_others(spark):
    begun = threading.Event()

    def slow():
        begun.set()
        spark.range(100_000_000_000).selectExpr("sum(sqrt(id))").collect()

    def fails():
        begun.wait(60)
        time.sleep(1)
        raise ValueError("broken")

    outcomes = jobs.run_side_by_side(spark, {"slow": slow, "bad": fails, "later": lambda: 1}, at_once=2, cancel_on_failure=True)
    assert [o.outcome for o in outcomes] == ["cancelled", "failed", "cancelled"]


def test_overlaps_against_all_pairs(spark):
    ranges = [(k, k * 1.5 - 20, k * 1.5 - 20 + k % 9) for k in range(40)] + [(90, None, 1.0), (91, 5.0, 2.0), (92, -100.0, 100.0), (93, 3.0, 3.0)]
    periods = [(f"p{k}", k * 4 - 15.5, k * 4 - 15.5 + k % 5 * 3) for k in range(14)] + [("all", -1000.0, 1000.0), ("none", None, None)]
    left = spark.createDataFrame(ranges, "id int, a double, b double")
    right = spark.createDataFrame(periods, "label string, c double, d double")
    wanted = sorted((i, p) for i, a, b in ranges for p, c, d in periods if None not in (a, b, c, d) and a <= b and c <= d and c < b and d > a)
    for width in (1, 7, 10_000):
        found = overlaps(left, right, "a", "b", "c", "d", width)
        assert found.columns == ["id", "a", "b", "label", "c", "d"]
        assert sorted((r.id, r.label) for r in found.collect()) == wanted
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
