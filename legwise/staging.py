"""Written intermediate tables in the cluster's shared folder.

Some plans need an intermediate result at a fixed point: a range partitioning
whose boundaries must not be drawn again, or a small aggregate whose true size
the optimizer should see.  Both are written as Parquet below the folder named
by ``spark.checkpoint.dir``, so they survive lost executors and cut lineage.

Reading a written aggregate back also settles the join strategy by measured
size: Spark broadcasts the side when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
with AQE splitting skewed partitions.

Tables whose rows are whole pages are written by ``stage_pages``, which bounds what a task holds of them.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group of staged pages.  A task that reads them unpacks 4096 rows at once, but of one row group only;
#: pages take about ten times their written size.
PAGE_GROUP = 2 << 20
#: Bytes of pages that a task sends to its Python worker at once.
PAGE_BATCH = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_batches = threading.Lock()
_bounded: dict[str, list] = {}  # session -> [writes under way, the session's own setting]


def shared_folder(spark: SparkSession) -> str:
    """The application's folder under ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own; a cluster must name a folder every executor can reach.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            named = tempfile.mkdtemp(prefix="legwise-")
        context.setCheckpointDir(named)
        folder = context.getCheckpointDir()
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the table read back from storage."""
    return _written(df, label)


def stage_pages(df: DataFrame, label: str) -> DataFrame:
    """``stage`` for a table with a whole page in each row, as text or as content.

    Its row groups are bounded in bytes, and so is what goes to the page reader at once, however
    many rows that is: one page at least, and the writer first looks at its size after ten.
    """
    with _small_batches(df.sparkSession):
        return _written(df, label, **{"parquet.block.size": str(PAGE_GROUP), "parquet.page.size.row.check.min": "10"})


def _written(df: DataFrame, label: str, **options: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python workers are of ``PAGE_BATCH`` bytes, or fewer if the session says so.

    The last of several writes at the same time puts the session's own setting back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _batches:
        state = _bounded.setdefault(session, [0, spark.conf.getAll.get(_BATCH_SETTING)])
        state[0] += 1
        own = state[1] and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(state[1])
        if state[0] == 1 and not (own and 0 < own <= PAGE_BATCH):
            spark.conf.set(_BATCH_SETTING, str(PAGE_BATCH))
    try:
        yield
    finally:
        with _batches:
            state[0] -= 1
            if not state[0]:
                del _bounded[session]
                if state[1] is None:
                    spark.conf.unset(_BATCH_SETTING)
                else:
                    spark.conf.set(_BATCH_SETTING, state[1])


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged.

    The application owns its staged tables: it calls this when the last table made from
    them has been written, at the latest before it stops its session.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt over ``partitions`` tasks, for heavy work per row on a table of few splits."""
    return df.repartition(partitions)
