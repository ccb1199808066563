"""Order-dependent operators that hold when one group has most of the rows.

A window over a whole group runs in one task.  Here the rows are range
partitioned by group and order instead, so every chunk is a bounded run of one or
more groups.  One pass over the sorted chunk adds what depends on order inside it
(numbers, the group's first row, the last known value), and the result is written
once, so the only shuffle of the rows is the range partitioning.  What a chunk
needs from earlier chunks of its group is a small carry table: a group spans several
chunks only if it begins before them, so at most one group per chunk has a carry and
the table has no more rows than there are chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from legwise.staging import stage

CHUNK, LOCAL = "_chunk", "_local"
#: Rows of a chunk at which a large table gets more chunks than there are shuffle partitions.
CHUNK_ROWS = 4_000_000


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in columns]


def _key(columns: Sequence[str]) -> Column:
    """Struct that compares like the ascending, nulls-last order."""
    parts = []
    for index, name in enumerate(columns):
        parts += [F.col(name).isNull().alias(f"n{index}"), F.col(name).alias(f"v{index}")]
    return F.struct(*parts)


def _sorted_chunks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows range partitioned and sorted by ``keys``, into chunks of about ``CHUNK_ROWS`` rows at most."""
    wanted = -(-df.select(F.lit(1)).count() // CHUNK_ROWS)
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(wanted, *_ascending(keys)) if wanted > default else df.repartitionByRange(*_ascending(keys))
    return ranged.sortWithinPartitions(*_ascending(keys))


def _changes(batch: pa.RecordBatch, group: Sequence[str], before: pa.RecordBatch | None) -> np.ndarray:
    """Whether each row begins a group; ``before`` is the row before the batch."""
    new = np.zeros(batch.num_rows, bool)
    new[0] = before is None
    for name in group:
        column = batch.column(name)
        last = before.column(name) if before is not None else column.slice(0, 1)
        column = pa.concat_arrays([last, column])
        here, there = column.slice(1), column.slice(0, len(column) - 1)
        same = pc.fill_null(pc.equal(here, there), False)
        both = pc.and_(pc.is_null(here), pc.is_null(there))
        new |= ~pc.or_(same, both).to_numpy(zero_copy_only=False)
    return new


def _in_chunk(batches, group: Sequence[str], first: Mapping[str, str], last: Mapping[str, str]):
    """Sorted rows with their number in (group, chunk), the group's first and last known values so far."""
    before, count, held = None, 0, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        new, index = _changes(batch, group, before), np.arange(batch.num_rows)
        start = np.maximum.accumulate(np.where(new, index, -1))
        local = np.where(start < 0, count + index + 1, index - start + 1)
        columns = [*batch.columns, pa.array(local, pa.int64())]
        for into, source in first.items():
            column = batch.column(source)
            known = pa.concat_arrays([held.get(into, pa.nulls(1, column.type)), column])
            columns.append(known.take(pa.array(start + 1)))
            held[into] = columns[-1].slice(batch.num_rows - 1)
        for into, source in last.items():
            column = batch.column(source)
            valid = np.maximum.accumulate(np.where(pc.is_valid(column).to_numpy(zero_copy_only=False), index, -1))
            known = pa.concat_arrays([held.get(into, pa.nulls(1, column.type)), column])
            columns.append(known.take(pa.array(valid + 1, mask=valid < start)))
            held[into] = columns[-1].slice(batch.num_rows - 1)
        before, count = batch.slice(batch.num_rows - 1), int(local[-1])
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, LOCAL, *first, *last])


def range_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    first: Mapping[str, str] | None = None,
    last: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows range partitioned by (group, order) and written with chunk number and place in (group, chunk).

    ``first`` and ``last`` map new columns to the columns whose first value, or last
    non-null value so far, in (group, chunk) they hold.  ``order`` should end in a
    column that tells rows of a group apart: rows equal in all keys share a chunk.
    Writing fixes the sampled boundaries; reading the plan twice would draw them again.
    """
    first, last = dict(first or {}), dict(last or {})
    types = {f.name: f.dataType for f in df.schema.fields}
    added = [StructField(LOCAL, LongType()), *[StructField(new, types[old]) for new, old in [*first.items(), *last.items()]]]
    chunks = _sorted_chunks(df, [*group, *order])
    placed = chunks.mapInArrow(lambda batches: _in_chunk(batches, group, first, last), StructType([*df.schema.fields, *added]))
    return stage(placed.withColumn(CHUNK, F.spark_partition_id()), "ranged")


def number_all(df: DataFrame, order: Sequence[str], number: str = "position") -> DataFrame:
    """Position 1..n over the whole table in ascending order, nulls last.

    Rows are written with their place inside the sorted partition; the rows before each
    partition are a table of one row per partition.
    """
    placed = stage(_sorted_chunks(df, order).withColumn("_place", F.monotonically_increasing_id()), "placed")
    rows = placed.withColumn(CHUNK, F.shiftrightunsigned("_place", 33))
    sizes = rows.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    window = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col(CHUNK).alias("_c"), F.coalesce(F.sum("_size").over(window), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition of the range shuffle
    joined = rows.join(F.broadcast(before), F.col(CHUNK) == F.col("_c"))
    return joined.withColumn(number, F.col("_before") + inside + 1).drop("_place", "_before", "_c", CHUNK)


def _earlier(group: Sequence[str]):
    window = Window.partitionBy(*group).orderBy(CHUNK)
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _join_carry(rows: DataFrame, carry: DataFrame, group: Sequence[str]) -> DataFrame:
    keys = [*group, CHUNK]
    renamed = carry.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys], *[c for c in carry.columns if c not in keys]
    )
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    # at most one row per chunk, see the module text
    return rows.join(F.broadcast(renamed), matched, "left").drop(*[f"_c_{k}" for k in keys])


def position_rows(
    rows: DataFrame, group: Sequence[str], number: str = "position", leaders: Sequence[str] = ()
) -> DataFrame:
    """Number the rows of ``range_rows`` 1..n per group; ``leaders`` are its ``first`` columns.

    A leader column gets the value of the whole group's first row.
    """
    sizes = rows.groupBy(*group, CHUNK).agg(
        F.max(LOCAL).alias("_size"),
        *[F.min_by(F.struct(name), LOCAL).alias(f"_first_{name}") for name in leaders],
    )
    earlier = _earlier(group)
    carry = sizes.select(
        *group,
        CHUNK,
        F.sum("_size").over(earlier).alias("_before"),
        *[F.first(f"_first_{name}").over(earlier).alias(f"_lead_{name}") for name in leaders],
    ).where(F.col("_before").isNotNull())
    joined = _join_carry(rows, carry, group)
    joined = joined.withColumn(number, F.col(LOCAL) + F.coalesce("_before", F.lit(0)))
    for name in leaders:
        begun = F.col(f"_lead_{name}").isNotNull()
        joined = joined.withColumn(name, F.when(begun, F.col(f"_lead_{name}").getField(name)).otherwise(F.col(name)))
    return joined.drop("_before", CHUNK, LOCAL, *[f"_lead_{name}" for name in leaders])


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], number: str = "position"
) -> DataFrame:
    """Position 1..n inside each group (whole table for no group), ascending, nulls last."""
    if not group:
        return number_all(df, order, number)
    return position_rows(range_rows(df, group, order), group, number)


def carry_forward(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, into: str
) -> DataFrame:
    """Last non-null ``value`` up to and including each row, in order, per group."""
    rows = range_rows(df, group, order, last={into: value})
    summary = rows.groupBy(*group, CHUNK).agg(F.max_by(into, LOCAL).alias("_last"))
    carry = summary.select(
        *group, CHUNK, F.last("_last", ignorenulls=True).over(_earlier(group)).alias("_carry")
    ).where(F.col("_carry").isNotNull())
    joined = _join_carry(rows, carry, group)
    return joined.withColumn(into, F.coalesce(into, "_carry")).drop("_carry", CHUNK, LOCAL)


def first_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, number: str = "position"
) -> DataFrame:
    """The first ``k`` rows per group.

    Spark limits each task's rows per group before the shuffle, so a large group
    sends at most ``k`` rows from every task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(number, F.row_number().over(window)).where(F.col(number) <= k)


def first_value_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The values of each group's first row in order, partially aggregated before the shuffle."""
    first = F.min_by(F.struct(*values), _key(order))
    return df.groupBy(*group).agg(first.alias("_first")).select(*group, "_first.*")
