"""Hilbert shards: the curve, the law, and the files."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from legwise.llm import hilbert_shards as shards


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(axes, bits):
    grid = np.stack(np.meshgrid(*[range(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    index = shards.hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    steps = np.abs(np.diff(grid[np.argsort(index)], axis=0))
    assert (steps.sum(axis=1) == 1).all()


def rows(spark, n, same=0):
    made = [(i, f"text {i}", "ab"[i % 2], f"src{i % 7 if i % 3 else 0}", i % 50, 1) for i in range(n)]
    made += [(None, None, None, None, None, None)] * 3 + [(4, "copy", "a", "src0", 5, 2)] * same
    return spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars int, shard int")


@pytest.mark.parametrize("same", [0, 40, 900])
def test_law_slots_and_content(spark, same):
    df = rows(spark, 300, same)
    written = shards.write_shards(df, shards.new_folder(spark), shards=8)
    total = df.count()
    counts = dict(written.groupBy("shard").count().collect())
    assert sorted(counts) == list(range(8)) and sum(counts.values()) == total and max(counts.values()) - min(counts.values()) <= 1
    assert all(r.low == 0 and r.high == r.n - 1 == r.kinds - 1 for r in written.groupBy("shard").agg(
        F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("kinds"), F.count(F.lit(1)).alias("n")).collect())
    back = written.select("doc_id", "text", "lang", "source", "n_chars", F.col("shard_").alias("shard"))
    assert back.exceptAll(df).count() == 0 == df.exceptAll(back).count()
    ends = written.groupBy("shard").agg(F.min("curve_index").alias("low"), F.max("curve_index").alias("high")).orderBy("shard").collect()
    assert all(a.high <= b.low for a, b in zip(ends, ends[1:]))


def test_few_and_no_rows(spark):
    few = shards.write_shards(rows(spark, 2).where("doc_id IS NOT NULL"), shards.new_folder(spark))
    assert few.count() == 2 and few.select("shard").distinct().count() == 2
    assert shards.write_shards(rows(spark, 2).limit(0), shards.new_folder(spark)).count() == 0


def test_shards_are_narrow_in_every_dimension(spark):
    df = spark.range(4096).selectExpr("id AS doc_id", "cast(id % 64 as string) AS lang", "id % 61 AS n_chars")
    df = df.withColumn("lang", F.lpad("lang", 2, "0"))
    written = shards.write_shards(df, shards.new_folder(spark), ("lang", "n_chars"))
    width = written.groupBy("shard").agg((F.max("n_chars") - F.min("n_chars")).alias("w"), F.countDistinct("lang").alias("l")).collect()
    assert np.mean([r.w for r in width]) < 40 and np.mean([r.l for r in width]) < 40


def test_no_column_is_lost(spark):
    """Names of added columns, of internal ones, and of what the added ones are renamed to."""
    names = ["shard", "shard_", "slot", "curve_index", "_id", "_hash", "_run", "_row", "_at", "_nth", "_begin", "position", "a b.c"]
    df = spark.range(60).selectExpr("id AS doc_id", "cast(id % 3 as string) AS lang", *[f"cast(id * {k} as string) AS `{n}`" for k, n in enumerate(names, 1)])
    written = shards.write_shards(df, shards.new_folder(spark), ("lang", "_run", "shard"), shards=4)
    assert set(written.columns) == {"doc_id", "lang", "shard", "slot", "curve_index", "shard__", "shard_", "slot_", "curve_index_", *names[4:]}
    renamed = {"shard": "shard__", "slot": "slot_", "curve_index": "curve_index_"}
    back = written.select("doc_id", "lang", *[F.col(f"`{renamed.get(n, n)}`").alias(n) for n in names])
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_against_one_global_order(spark):
    """Slots are places in the plain order by (curve index, id, hash)."""
    df = rows(spark, 500).select("doc_id", "text", "lang", "source", "n_chars")
    written = shards.write_shards(df, shards.new_folder(spark), shards=7).collect()
    assert sorted(r.curve_index for r in written) == [r.curve_index for r in sorted(written, key=lambda r: (r.shard, r.slot))]
    for a, b in zip(ordered := sorted(written, key=lambda r: (r.shard, r.slot)), ordered[1:]):
        assert (a.curve_index, a.doc_id is None, a.doc_id or 0) <= (b.curve_index, b.doc_id is None, b.doc_id or 0)


def test_runs_grow_with_the_texts(spark, monkeypatch):
    monkeypatch.setattr(shards, "RUN_BYTES", 1000)
    df = rows(spark, 400, 5)
    written = shards.write_shards(df, shards.new_folder(spark), shards=4)
    assert written.count() == df.count() and len(written.inputFiles()) >= 4
    assert sorted(r.slot for r in written.where("shard = 1").collect()) == list(range(written.where("shard = 1").count()))
