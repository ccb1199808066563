"""Whether written rows lie in order, found by one pass that neither sorts nor shuffles them.

Each split of a file compares its neighbouring rows and keeps its first and last key; the splits, a
row each, are then compared at their borders in the order of file names and places.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.schema import EDITION_KEY


def _descents(before: Sequence[pa.Array], after: Sequence[pa.Array]) -> np.ndarray:
    """Where the keys ``before`` come after those at the same places of ``after``; nulls are last."""
    equal, down = np.ones(len(before[0]), bool), np.zeros(len(before[0]), bool)
    for left, right in zip(before, after, strict=True):
        none, none_after = (pc.is_null(c).to_numpy(zero_copy_only=False) for c in (left, right))
        less, greater = (pc.fill_null(f(left, right), False).to_numpy(zero_copy_only=False) for f in (pc.less, pc.greater))
        falls = greater | none & ~none_after
        down |= equal & falls
        equal &= ~(falls | less | none_after & ~none)
    return down


def _splits(batches, n_keys: int, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Per split: rows, descents, and its first and last row."""
    open_split, first, last, rows, faults = None, None, None, 0, 0

    def result() -> pa.RecordBatch:
        head = [pa.array([open_split[0]]), pa.array([open_split[1]], pa.int64()), pa.array([rows], pa.int64()), pa.array([faults], pa.int64())]
        return pa.RecordBatch.from_arrays([*head, *first, *last[-n_keys:]], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
            columns = [c.slice(begin, end - begin) for c in batch.columns[2:]]
            split = batch.column(0)[begin].as_py(), int(block[begin])
            if split != open_split:
                if open_split is not None:
                    yield result()
                open_split, first, last, rows, faults = split, [c.slice(0, 1) for c in columns], None, 0, 0
            keys = columns[-n_keys:]
            faults += int(_descents([k.slice(0, len(k) - 1) for k in keys], [k.slice(1) for k in keys]).sum())
            if last is not None:
                faults += int(_descents(last[-n_keys:], [k.slice(0, 1) for k in keys])[0])
            rows += end - begin
            last = [c.slice(end - begin - 1, 1) for c in columns]
    if open_split is not None:
        yield result()


def order_faults(spark: SparkSession, path: str, schema: T.StructType, order: Sequence[str], group: Sequence[str] = EDITION_KEY) -> DataFrame:
    """``group``, ``rows`` and ``faults``: how many rows of each written group come before one that they should follow.

    Groups are folders of the table, so a file has rows of one group.  Keys compare as in a sort with nulls
    last; equal keys are in order.
    """
    stored = spark.read.schema(schema).parquet(path)
    rows = stored.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), *group, *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)]
    )
    kinds = {f.name: f.dataType for f in rows.schema}
    fields = [("_file", T.StringType()), ("_block", T.LongType()), ("rows", T.LongType()), ("inner", T.LongType())]
    fields += [(g, kinds[g]) for g in group] + [(f"_{side}{k}", kinds[f"_o{k}"]) for side in ("first", "last") for k in range(len(order))]
    shape = T.StructType([T.StructField(n, kind) for n, kind in fields])
    names, n_keys = shape.names, len(order)
    splits = rows.mapInArrow(lambda batches: _splits(batches, n_keys, names), shape)

    def key(side: str) -> Column:
        return F.struct(*[part for k in range(n_keys) for part in (F.col(f"_{side}{k}").isNull().alias(f"n{k}"), F.col(f"_{side}{k}").alias(f"v{k}"))])

    before = F.lag(key("last")).over(Window.partitionBy(*group).orderBy("_file", "_block"))
    judged = splits.withColumn("border", F.coalesce((before > key("first")).cast("int"), F.lit(0)))
    return judged.groupBy(*group).agg(F.sum("rows").alias("rows"), F.sum(F.col("inner") + F.col("border")).alias("faults"))
