"""How the driver's tables take the roles of legs, leg rankings and standings.

Every view exists twice, as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from legwise.functions.durations import duration_text
from legwise.schema import INDIVIDUAL


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def columns_of(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some of a table's columns, read where its files are."""
    df = table(spark, sf_dir, name)
    return df.select(*columns) if columns else df


# --- leg rankings: one row per series, edition, leg and participant ----------


def leg_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    supplier = F.min("l_suppkey")
    return (
        items.groupBy(
            F.col("l_linestatus").alias("series"),
            F.year("l_shipdate").alias("edition"),
            F.quarter("l_shipdate").cast("double").alias("leg"),
            F.col("l_partkey").cast("string").alias("participant"),
        )
        .agg(
            F.sum("l_quantity").cast("bigint").alias("total_seconds"),
            F.when(supplier % 5 != 0, F.concat(F.lit("Team "), supplier.cast("string"))).alias("team"),
        )
        .withColumn("classification", F.lit(INDIVIDUAL))
    )


LEG_RANKINGS = """
leg_rankings AS (
  SELECT l_linestatus AS series, CAST(year(l_shipdate) AS INTEGER) AS edition,
         CAST(quarter(l_shipdate) AS DOUBLE) AS leg, CAST(l_partkey AS VARCHAR) AS participant,
         CAST(sum(l_quantity) AS BIGINT) AS total_seconds,
         CASE WHEN min(l_suppkey) % 5 <> 0 THEN 'Team ' || min(l_suppkey) END AS team
  FROM lineitem GROUP BY ALL
)"""


# --- leg listings: every shipped line as one row of a leg ranking --------------

LISTING_ORDER = ("leg", "row_no", "line", "supplier")


def leg_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as ranking rows; a participant may be listed more than once in a leg."""
    supplier = F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("series"),
        F.year("l_shipdate").alias("edition"),
        F.quarter("l_shipdate").cast("double").alias("leg"),
        F.col("l_partkey").cast("string").alias("participant"),
        F.col("l_quantity").cast("bigint").alias("total_seconds"),
        F.when(supplier % 5 != 0, F.concat(F.lit("Team "), supplier.cast("string"))).alias("team"),
        F.col("l_orderkey").alias("row_no"),
        F.col("l_linenumber").alias("line"),
        supplier.alias("supplier"),
        F.lit(INDIVIDUAL).alias("classification"),
    )


LEG_LISTINGS = """
leg_listings AS (
  SELECT l_linestatus AS series, CAST(year(l_shipdate) AS INTEGER) AS edition, quarter(l_shipdate) AS leg,
         CAST(l_partkey AS VARCHAR) AS participant, CAST(l_quantity AS BIGINT) AS total_seconds,
         CASE WHEN l_suppkey % 5 <> 0 THEN 'Team ' || l_suppkey END AS team,
         l_orderkey AS row_no, l_linenumber AS line, l_suppkey AS supplier
  FROM lineitem
)"""


# --- legs: one row per shipped line's series and edition, distance per edition


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters as legs; the first row in key order carries the edition's distance."""
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(
        F.col("l_linestatus").alias("series"),
        F.year("l_shipdate").alias("edition"),
        F.quarter("l_shipdate").cast("bigint").alias("row_no"),
    ).agg(F.max("l_orderkey").alias("total_distance"))


LEGS = """
legs AS (
  SELECT l_linestatus AS series, CAST(year(l_shipdate) AS INTEGER) AS edition,
         quarter(l_shipdate) AS row_no, max(l_orderkey) AS total_distance
  FROM lineitem GROUP BY ALL
)"""


# --- known editions: orders; series F ends a year earlier, series O has none


def known_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderstatus") != "O").select(
        F.col("o_orderstatus").alias("series"),
        (F.year("o_orderdate") - 1).alias("edition"),
        F.col("o_custkey").cast("string").alias("participant"),
    )


KNOWN_STANDINGS = """
known_standings AS (
  SELECT o_orderstatus AS series, CAST(year(o_orderdate) - 1 AS INTEGER) AS edition,
         CAST(o_custkey AS VARCHAR) AS participant
  FROM orders WHERE o_orderstatus <> 'O'
)"""


# --- results: orders as printed standings, three series in different years ---


def _result_edition():
    series = F.col("o_orderstatus")
    return F.year("o_orderdate") - F.when(series == "F", 0).when(series == "O", 82).otherwise(92)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    series, edition = F.col("o_orderstatus"), _result_edition()
    total = F.floor("o_totalprice")
    priority = F.col("o_orderpriority")
    return orders.select(
        series.alias("series"),
        edition.alias("edition"),
        F.col("o_orderkey").alias("row_no"),
        F.when(priority == "4-NOT SPECIFIED", "DSQ")
        .otherwise((F.col("o_custkey") % 50 + 1).cast("string"))
        .alias("rank_text"),
        F.col("o_custkey").cast("string").alias("participant"),
        priority.alias("team"),
        F.when(priority == "3-MEDIUM", "n/a").otherwise(duration_text(total)).alias("times"),
        F.when(priority == "1-URGENT", "-")
        .otherwise(F.concat(F.lit("+ "), duration_text(F.floor(F.col("o_totalprice") / 2))))
        .alias("gap"),
        F.when(edition == 1997, 0).otherwise(edition * 2 - 300).cast("int").alias("distance"),
    )


RESULTS = """
printed AS (
  SELECT o_orderstatus AS series,
         CAST(year(o_orderdate) - CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 82 ELSE 92 END AS INTEGER) AS edition,
         o_orderkey AS row_no, o_orderpriority AS team, CAST(o_custkey AS VARCHAR) AS participant,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey % 50 + 1 END AS rank_number,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS printed_total,
         CASE WHEN o_orderpriority = '1-URGENT' OR o_totalprice / 2 >= 180001 THEN 0
              ELSE CAST(floor(o_totalprice / 2) AS BIGINT) END AS printed_gap
  FROM orders
),
typed AS (
  SELECT *, CASE WHEN edition IN (1905, 1906, 1908) THEN 'no-results'
                 WHEN edition IN (1907, 1909, 1910, 1911, 1912) THEN 'points' ELSE 'time' END AS result_type,
         CAST(CASE WHEN edition = 1997 THEN 0 ELSE edition * 2 - 300 END AS INTEGER) AS distance,
         CASE WHEN rank_number IS NULL THEN 'DSQ' ELSE CAST(rank_number AS VARCHAR) END AS rank_text
  FROM printed
),
timed AS (
  SELECT *, CASE WHEN result_type = 'time' THEN printed_total ELSE 0 END AS own_seconds,
         CASE WHEN result_type = 'time' THEN printed_gap ELSE 0 END AS gap_seconds
  FROM typed
),
results AS (
  SELECT * EXCLUDE (own_seconds),
         CASE WHEN edition IN (1997, 2006)
               AND row_no <> min(row_no) OVER (PARTITION BY series, edition)
              THEN first_value(own_seconds) OVER (PARTITION BY series, edition ORDER BY row_no) + gap_seconds
              ELSE own_seconds END AS total_seconds
  FROM timed
)"""


def result_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legs of the results view: the months in which an edition has orders."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderstatus").alias("series"),
        _result_edition().alias("edition"),
        F.month("o_orderdate").alias("leg"),
    ).distinct()


RESULT_LEGS = """
result_legs AS (
  SELECT DISTINCT p.series, p.edition, month(o_orderdate) AS leg
  FROM printed p JOIN orders ON o_orderkey = p.row_no
)"""
