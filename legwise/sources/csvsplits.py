"""CSV files read by many tasks each, with line breaks inside quoted cells.

A split of a file does not tell whether it begins inside a quoted cell.  So a first pass over the
lines finds, for every split, where it ends if it begins outside quotes and where if it begins inside:
a function of one bit.  These functions, a row per split, are composed along each file.  The second
pass begins each split in its true state and puts lines together to records.  A record that crosses
splits leaves a fragment in each; fragments are few and are joined by file and order.  Records become
columns with ``from_csv``.

Quotes open a cell only at its beginning, are doubled inside one, and what follows a closing
quote up to the next comma belongs to the cell.  Lines end with a line feed, or with a carriage
return before it, which is not part of the last cell.  A file that ends inside quotes is an error.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from legwise.staging import stage

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+),)*+'
#: A line that begins outside quotes, or inside, and ends inside.
_OPENS = re.compile(rf'{_CELLS}"{_INSIDE}\Z')
_STAYS = re.compile(rf'{_INSIDE}(?:"[^,]*+,{_CELLS}"{_INSIDE})?\Z')
WHOLE, FRAGMENT, HEADER_FRAGMENT = 0, 1, 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line ends inside a quoted cell if it begins there or not."""
    return (_STAYS if inside else _OPENS).match(line) is not None


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """Neighbouring lines of one split: (file, block), first, last."""
    file, block = (batch.column(k).to_numpy() for k in (1, 2))
    edges = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    bounds = [0, *edges.tolist(), batch.num_rows]
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last > first:
            yield (int(file[first]), int(block[first])), first, last


def _quoted(lines: pa.Array) -> np.ndarray:
    return np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))


def _ends(batches) -> Iterator[pa.RecordBatch]:
    """Per split: does it end inside if it begins outside, and if it begins inside; and its file's name."""
    found: dict[tuple[int, int], list[bool]] = {}
    names: dict[tuple[int, int], str] = {}
    for batch in batches:
        quoted = _quoted(batch.column(0))
        for split, first, last in _runs(batch):
            state = found.setdefault(split, [False, True])
            if split not in names:
                names[split] = batch.column(3)[first].as_py()
            for k in quoted[np.searchsorted(quoted, first) : np.searchsorted(quoted, last)]:
                line = batch.column(0)[int(k)].as_py()
                outside = ends_inside(line, state[0])
                state[:] = [outside, outside if state[0] == state[1] else ends_inside(line, state[1])]
    splits = list(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array([s[k] for s in splits], pa.int64()) for k in (0, 1)] + [pa.array([found[s][k] for s in splits], pa.bool_()) for k in (0, 1)]
        + [pa.array([names[s] for s in splits], pa.string())],
        ["file", "block", "from_outside", "from_inside", "path"],
    )


def _records(batches) -> Iterator[pa.RecordBatch]:
    """Records behind the headers, and fragments of those that cross splits, with the number of their first line in the split."""
    split, inside, continued, header_due, number, parts, begun = None, False, False, False, 0, [], 0
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal header_due
        if parts:
            if header_due and kind == WHOLE:
                header_due = False  # quoted, so not empty
            else:
                out.append(("\n".join(parts), *split, begun, HEADER_FRAGMENT if header_due else kind))
            parts.clear()

    for batch in batches:
        lines, states = batch.column(0), batch.column(3)
        quoted = _quoted(lines)
        for here, first, last in _runs(batch):
            if here != split:
                close(FRAGMENT if inside else WHOLE)
                split, inside, number = here, states[first].as_py(), 0
                continued = inside  # what comes first belongs to a record of the split before
                header_due = here[1] == 0
            at = first
            for mark in [*quoted[np.searchsorted(quoted, first) : np.searchsorted(quoted, last)].tolist(), last]:
                if mark > at:  # lines without quotes
                    between = lines.slice(at, mark - at).to_pylist()
                    if inside:
                        begun = begun if parts else number
                        parts.extend(between)
                    else:
                        for k, text in enumerate(between):
                            if header_due and text.strip("\r"):
                                header_due = False
                            else:
                                out.append((text, *split, number + k, WHOLE))
                    number += mark - at
                if mark < last:
                    line = lines[mark].as_py()
                    begun = begun if parts else number
                    parts.append(line)
                    inside = ends_inside(line, inside)
                    number += 1
                    at = mark + 1
                    if not inside:
                        close(FRAGMENT if continued else WHOLE)
                        continued = False
        if out:
            yield _record_batch(out)
            out = []
    close(FRAGMENT if inside else WHOLE)
    if out:
        yield _record_batch(out)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["record", "file", "block", "line", "kind"])


def _lines(spark: SparkSession, path: str | Sequence[str], *more: Column) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), *more
    )


def begins(spark: SparkSession, path: str | Sequence[str], with_path: bool = False) -> DataFrame:
    """``file`` (a hash), ``block``, ``inside`` of every split: whether it begins inside quotes; written.

    A row of 17 bytes per split of the files, and the file's name if it is wanted.
    """
    named = (F.col("_metadata.file_path") if with_path else F.lit("")).alias("path")
    shape = "file bigint, block bigint, from_outside boolean, from_inside boolean, path string"
    ends = stage(_lines(spark, path, named).mapInArrow(_ends, shape), "split-ends")
    turns = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    settled = F.col("from_outside") == F.col("from_inside")
    order = Window.partitionBy("file").orderBy("block")
    counted = ends.withColumn("turned", F.sum(turns).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fixed = F.when(settled, F.struct(F.col("from_outside").cast("int").alias("state"), "turned"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = counted.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(before)).withColumn("_turned", F.coalesce(F.max("turned").over(before), F.lit(0)))
    state = F.coalesce(F.col("_fixed.state"), F.lit(0)) + F.col("_turned") - F.coalesce(F.col("_fixed.turned"), F.lit(0))
    inside = (state % 2 == 1).alias("inside")
    last = F.lead("block").over(order).isNull()
    found = stage(known.select("file", "block", "path", inside, "from_outside", "from_inside", last.alias("last")), "split-begins")
    open_end = found.where(F.col("last") & F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    if not open_end.isEmpty():
        named = spark.read.text(path).select(F.col("_metadata.file_path").alias("path")).withColumn("file", F.xxhash64("path"))
        names = named.join(open_end, "file", "left_semi").select("path").distinct().limit(5).collect()
        raise ValueError("ends inside quotes: " + ", ".join(r.path for r in names))
    return found.select("file", "block", "path", "inside")


def scan_records(spark: SparkSession, path: str | Sequence[str], known: DataFrame) -> DataFrame:
    """``record``, ``file``, ``block`` and ``line`` (of its beginning) of every record behind the files' headers.

    The first record of a file that is not empty is its header; empty ones are left out.
    ``known`` is what ``begins`` found.  The order of a file's records is that of (block, line).
    """
    lines = _lines(spark, path)
    # a row per split; its lines stay in their order, which a shuffle would not keep
    beside = lines.join(F.broadcast(known), ["file", "block"], "left")
    unknown = F.raise_error(F.lit("the files' splits changed while they were read")).cast("boolean")
    placed = beside.select("value", "file", "block", F.when(F.col("inside").isNotNull(), F.col("inside")).otherwise(unknown).alias("inside"))
    found = placed.mapInArrow(_records, "record string, file bigint, block bigint, line bigint, kind int")
    records = found.where(F.col("kind") == WHOLE).drop("kind")
    if not known.where("inside").isEmpty():
        fragments = found.where(F.col("kind") != WHOLE)
        place = Window.partitionBy("file").orderBy("block", "line")
        # a record's first fragment is the one that does not begin where its split does, or whose split begins outside
        first = fragments.join(F.broadcast(known), ["file", "block"]).withColumn("first", ~(F.col("inside") & (F.col("line") == 0)))
        numbered = first.withColumn("nth", F.sum(F.col("first").cast("int")).over(place))
        joined = numbered.groupBy("file", "nth").agg(
            F.sort_array(F.collect_list(F.struct("block", "line", "record", "kind"))).alias("parts")
        ).where(F.get("parts", F.lit(0))["kind"] != HEADER_FRAGMENT)
        whole = F.concat_ws("\n", F.transform("parts", lambda p: p["record"])).alias("record")
        head = F.get("parts", F.lit(0))
        records = records.unionByName(joined.select(whole, "file", head["block"].alias("block"), head["line"].alias("line")))
    record = F.regexp_replace("record", r"\r\z", "")
    return records.withColumn("record", record).where(F.col("record") != "")


def scan_split_csv(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], with_path: bool = False) -> DataFrame:
    """Text columns ``names`` of all records, behind ``path`` (if wanted), ``block`` and ``line``, which give their order."""
    known = begins(spark, path, with_path)
    records = scan_records(spark, path, known)
    if with_path:  # a row per file
        records = records.join(F.broadcast(known.select("file", "path").distinct()), "file")
    fields = ", ".join(f"c{k} string" for k in range(len(names)))
    cells = F.from_csv("record", fields, {"escape": '"', "multiLine": "true", "lineSep": "\n"})
    place = ["path", "block", "line"] if with_path else ["block", "line"]
    return records.select(*place, cells.alias("cells")).select(*place, *[F.col(f"cells.c{k}").alias(n) for k, n in enumerate(names)])


# The reader travels with the job, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
