"""Scans and sinks: CSV exports, partitioned Parquet tables, edition replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.functions.numbers import to_number
from legwise.schema import EDITION_KEY, MISSING_TEXTS
from legwise.sources.csvsplits import scan_split_csv


def missing_to_null(text: Column) -> Column:
    """NULL for the texts a CSV cell may hold instead of a value."""
    return F.when(~text.isin(*MISSING_TEXTS), text)


# Columns that put scanned CSV rows back into the order of their files.
SOURCE_ORDER = ("_part", "_file", "_block", "_line")


def scan_csv(
    spark: SparkSession, path: str, multiline: bool = True, with_order: bool = False
) -> DataFrame:
    """A CSV with header as text columns, missing markers as NULL.

    Large files are read by many tasks each.  Quoted line breaks are read by default, which takes a
    first pass over the files; ``multiline=False`` does without it and is only for files without such cells.
    ``with_order`` adds the columns of SOURCE_ORDER: number in a part file's name, file, start of
    the split in it, and a number that grows with the rows of a split.
    """
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    cells = [f"c{k}" for k in range(len(raw.columns))]
    if multiline and cells:
        rows = scan_split_csv(spark, path, cells, with_order)
    else:
        origin = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")]
        place = [*origin, F.monotonically_increasing_id().alias("line")] if with_order else []
        rows = raw.select(*place, *[F.col(f"`{c}`").alias(cell) for c, cell in zip(raw.columns, cells)])
    columns = [missing_to_null(F.col(cell)).alias(c) for c, cell in zip(raw.columns, cells)]
    if with_order:
        part = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).try_cast("bigint")
        places = [F.coalesce(part, F.lit(-1)), F.col("path"), F.col("block"), F.col("line")]
        columns += [place.alias(name) for place, name in zip(places, SOURCE_ORDER)]
    return rows.select(*columns)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the schema's types, unreadable values as NULL, absent columns as NULL."""
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            value = F.coalesce(value.try_cast(field.dataType), to_number(value).try_cast(field.dataType))
        elif not isinstance(field.dataType, T.StringType):
            value = value.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def scan_table(
    spark: SparkSession, path: str, schema: T.StructType, required: bool = False
) -> DataFrame:
    """A Parquet table; a missing one is an empty table, or an error when required."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        if required:
            raise FileNotFoundError(f"missing table: {path}") from error
        return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = EDITION_KEY, sort_by: Sequence[str] = ()
) -> None:
    """Write a whole table, partitioned by series and edition.

    ``rebalance`` gathers each edition into few files and splits an oversized one.
    """
    sorted_writer(df, partition_by, sort_by).mode("overwrite").parquet(path)


def replace_editions(
    df: DataFrame, path: str, partition_by: Sequence[str] = EDITION_KEY, sort_by: Sequence[str] = ()
) -> None:
    """Overwrite only the editions present in ``df``; all others stay as they are."""
    (
        sorted_writer(df, partition_by, sort_by)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def sorted_writer(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrameWriter:
    """A writer of balanced files per partition, sorted; the caller sets mode and format."""
    balanced = df.hint("rebalance", *partition_by)
    if sort_by:
        balanced = balanced.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in (*partition_by, *sort_by)])
    return balanced.write.partitionBy(*partition_by)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header and without an index; missing values are empty cells, blanks at the ends stay."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    writer.options(**kept).csv(path)
