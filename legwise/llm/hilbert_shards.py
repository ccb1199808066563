"""Sharding along a Hilbert curve for file pruning on several columns.

Each dimension is quantised at its own quantiles over all rows, the bins of a row
give its index on the curve, and the rows in curve order are cut into runs.  Rows of
a shard are therefore near each other in every dimension, and the Parquet statistics
of a shard's files rule most of them out for filters on any of the dimensions.

The law of the cut is ``rows``: counts of shards are at most one apart.  Ranks come
from a table of keys without texts; texts are shuffled once, straight to the run
they belong to.

Defined results: null dimensions sort before all values, null ids last; repeated
rows take neighbouring slots of one run; a column of the input that has the name of an added one
is written with underscores behind it, all others keep their names; ids that are no whole numbers
are an error; a null text has no bytes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from legwise.operators.ordering import number_all
from legwise.staging import shared_folder

SHARDS = 16
#: Bits of each dimension on the curve.
BITS = 5
#: Texts sorted by one task; there are as many runs as that takes.
RUN_BYTES = 128 << 20
ADDED = ("shard", "slot", "curve_index")


def hilbert_index(bins: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of points with ``bits``-bit coordinates, one row each (Skilling's transform)."""
    axes = [bins[:, k].astype(np.int64) for k in range(bins.shape[1])]
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for k in range(len(axes)):
            up = (axes[k] & level) != 0
            swap = np.where(up, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(up, axes[0] ^ low, axes[0]) ^ swap
            axes[k] = axes[k] ^ swap if k else axes[0]
        level >>= 1
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn, level = np.zeros(len(bins), np.int64), top
    while level > 1:
        turn = np.where((axes[-1] & level) != 0, turn ^ (level - 1), turn)
        level >>= 1
    index = np.zeros(len(bins), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            index = index << 1 | ((axis ^ turn) >> bit) & 1
    return index


def _number(df: DataFrame, name: str) -> Column:
    """A dimension as a number in its own order; strings by their first seven bytes."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (StringType, BinaryType)):
        digits = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 7)), 14, "0")
        column = F.conv(digits, 16, 10)
    return F.coalesce(column.cast("double"), F.lit(float("-inf")))


def curve(df: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> Column:
    """Column: the Hilbert index of a row's bins, whose bounds are quantiles over all rows."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [_number(df, d) for d in dimensions]
    found = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(str(k)) for k, n in enumerate(numbers)]).first()
    bounds = [np.array(found[k] or [], float) for k in range(len(dimensions))]

    @F.pandas_udf("bigint")
    def index(*values: pd.Series) -> pd.Series:
        bins = [np.searchsorted(b, v.to_numpy(float), "right") for b, v in zip(bounds, values)]
        return pd.Series(hilbert_index(np.stack(bins, axis=1), bits))

    return index(*numbers)


def _run_of(keys: list[tuple[int, int, int]]):
    """Pandas UDF: how many of the sorted ``keys`` are not above a row's key."""
    packed = np.array([np.array(k, ">i8").view(">u8") ^ np.uint64(1 << 63) for k in keys], ">u8").reshape(-1, 3)
    cuts = np.ascontiguousarray(packed).view("S24").ravel()

    @F.pandas_udf("int")
    def run(first: pd.Series, second: pd.Series, third: pd.Series) -> pd.Series:
        rows = np.stack([c.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in (first, second, third)], axis=1)
        mine = np.ascontiguousarray(rows.astype(">u8")).view("S24").ravel()
        return pd.Series(np.searchsorted(cuts, mine, "right").astype(np.int32))

    return run


def write_shards(
    docs: DataFrame,
    folder: str,
    dimensions: Sequence[str] = ("lang", "source", "n_chars", "doc_id"),
    key: str = "doc_id",
    shards: int = SHARDS,
    bits: int = BITS,
) -> DataFrame:
    """Write ``docs`` below ``folder``, a directory per shard, in curve order; the written table.

    Added columns: ``shard``, ``slot`` (place in the shard, from 0) and ``curve_index``.
    """
    spark = docs.sparkSession
    names = _free_names(docs.columns)
    renamed = docs.select(*[F.col(f"`{c}`").alias(names[c]) for c in docs.columns])
    dimensions = [names[d] for d in dimensions]
    columns = [F.col(f"`{c}`") for c in renamed.columns]
    # ids in order, then a hash of the whole row, so that equal keys are equal rows; the row itself is one struct
    identity = F.coalesce(F.col(f"`{names[key]}`").cast("bigint"), F.lit((1 << 63) - 1))
    keyed = renamed.select(
        curve(renamed, dimensions, bits).alias("curve_index"), identity.alias("_id"), F.xxhash64(*columns).alias("_hash"), F.struct(*columns).alias("_row")
    )
    order = ["curve_index", "_id", "_hash"]
    ranked = number_all(keyed.select(*order), order).withColumn("_at", F.col("position") - 1)
    total = ranked.count()
    texts = [F.coalesce(F.octet_length(f"`{c}`"), F.lit(0)) for c, kind in renamed.dtypes if kind in ("string", "binary")]
    size = renamed.agg(F.sum(sum(texts, F.lit(16 * len(columns))).cast("bigint"))).first()[0] or 0
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RUN_BYTES)
    runs = shards * math.ceil(least / shards)
    run_of_rank = F.floor(F.col("_at") * runs / F.lit(max(total, 1)))
    # one row per run: the first key of every run but the first
    heads = ranked.where((F.col("_at") > 0) & (run_of_rank != F.floor((F.col("_at") - 1) * runs / F.lit(max(total, 1)))))
    keys = sorted(tuple(r) for r in heads.select(*order).collect())
    run = _run_of(keys)
    begins = ranked.groupBy(run(*order).alias("_run")).agg(F.min("_at").alias("_begin"))
    dealt = keyed.withColumn("_run", run(*order)).repartitionByRange(runs, "_run")
    inside = F.row_number().over(Window.partitionBy("_run").orderBy(*order))
    # two numbers a run, of RUN_BYTES or more each
    placed = dealt.withColumn("_nth", inside).join(F.broadcast(begins), "_run").withColumn("_at", F.col("_begin") + F.col("_nth") - 1)
    shard = F.floor(F.col("_at") * shards / F.lit(max(total, 1)))
    placed = placed.withColumn("_shard", shard.cast("int"))
    first = F.ceil(F.col("_shard") * F.lit(total) / shards)
    placed = placed.select("_row.*", "curve_index", F.col("_shard").alias("shard"), (F.col("_at") - first).cast("bigint").alias("slot"))
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return spark.read.schema(placed.schema).parquet(folder)


def _free_names(columns: Sequence[str]) -> dict[str, str]:
    """Names of the written columns: one that is an added one's gets underscores until it is nobody else's."""
    names = {}
    for column in columns:
        name = column
        while name in ADDED or name != column and name in columns:
            name += "_"
        names[column] = name
    return names


def new_folder(spark) -> str:
    return f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
