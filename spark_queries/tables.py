"""Scans, sinks, unions and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.operators import joins
from legwise.operators.analytics import overlaps
from legwise.operators.ordering import number_rows
from legwise.operators.written_order import order_faults
from legwise.plans.jobs import export_jobs, outcome_table, run_side_by_side
from legwise.schema import Role
from legwise.sources import tables as sources
from legwise.staging import shared_folder
from spark_queries.registry import query
from spark_queries.views import table

_ORDER_TYPES = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)


@query(
    "scan_filter_orders",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 300000
    """,
)
def scan_filter_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000)).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "csv_roundtrip",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
           CASE o_custkey % 3 WHEN 0 THEN '  ' || o_orderstatus || ' ' WHEN 1 THEN o_orderstatus || chr(10) || 'x' ELSE 'a, "b"' END AS note
    FROM orders
    """,
)
def csv_roundtrip(spark, sf_dir):
    """Export to CSV and scan it back: missing markers become NULL, texts are typed, blanks and line breaks stay."""
    priority = F.col("o_orderpriority")
    exported = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        F.when(priority == "5-LOW", "N/A").otherwise(priority).alias("o_orderpriority"),
        F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")))
        .when(F.col("o_custkey") % 3 == 1, F.concat("o_orderstatus", F.lit("\nx")))
        .otherwise('a, "b"')
        .alias("note"),
    )
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    sources.export_csv(exported, path)
    return sources.typed(sources.scan_csv(spark, path), _ORDER_TYPES)


@query(
    "replace_written_editions",
    """
    SELECT o_orderkey, o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS edition,
           o_totalprice * CASE WHEN year(o_orderdate) = 2001 THEN 2 ELSE 1 END AS price
    FROM orders
    """,
)
def replace_written_editions(spark, sf_dir):
    """Write a partitioned table, then overwrite only its newest editions."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("series"),
        F.year("o_orderdate").alias("edition"),
        F.col("o_totalprice").alias("price"),
    )
    path = f"{shared_folder(spark)}/editions-{uuid.uuid4().hex}"
    sources.write_table(orders, path, sort_by=["o_orderkey"])
    newest = orders.where(F.col("edition") == 2001).withColumn("price", F.col("price") * 2)
    sources.replace_editions(newest, path, sort_by=["o_orderkey"])
    return sources.scan_table(spark, path, orders.schema, required=True)


@query(
    "union_ragged",
    """
    SELECT c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key,
           c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier
    """,
)
def union_ragged(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("party_name"),
        F.col("s_suppkey").alias("party_key"),
        F.col("s_nationkey").alias("nation_key"),
    )
    return joins.union_by_name(customers, suppliers)


_NULL_KEYS = """
  WITH keyed AS (SELECT o_orderkey, nullif(o_custkey, 7) AS custkey FROM orders),
  dimension AS (SELECT nullif(c_custkey, 7) AS custkey, c_mktsegment FROM customer)
  SELECT k.custkey, o_orderkey, c_mktsegment
  FROM keyed k LEFT JOIN dimension d ON k.custkey IS NOT DISTINCT FROM d.custkey
"""


@query("left_join_nullsafe", _NULL_KEYS)
def left_join_nullsafe(spark, sf_dir):
    """A missing key finds the row with the missing key."""
    orders = table(spark, sf_dir, "orders").select(
        F.nullif("o_custkey", F.lit(7)).alias("custkey"), "o_orderkey"
    )
    customers = table(spark, sf_dir, "customer").select(
        F.nullif("c_custkey", F.lit(7)).alias("custkey"), "c_mktsegment"
    )
    return joins.left_join_nullsafe(orders, customers, ["custkey"])


@query(
    "lookup_default",
    """
    SELECT o_orderkey, o_custkey, coalesce(c_acctbal, 0) AS c_acctbal
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) ON c_custkey = o_custkey
    """,
)
def lookup_default(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 5000)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup(
        orders, rich.withColumnRenamed("c_custkey", "o_custkey"), ["o_custkey"], "c_acctbal", 0.0
    )


@query(
    "fallback_union",
    """
    WITH listed AS (SELECT o_orderkey, o_custkey, o_orderkey % 2 AS side FROM orders)
    SELECT o_orderkey, o_custkey, 'primary' AS origin FROM listed WHERE side = 0
    UNION ALL
    SELECT o_orderkey, o_custkey, 'fallback' FROM listed WHERE side = 1
      AND o_custkey NOT IN (SELECT o_custkey FROM listed WHERE side = 0)
    """,
)
def fallback_union(spark, sf_dir):
    """Orders with an even key, and the others for customers without any; together all orders are read."""
    orders = table(spark, sf_dir, "orders")

    def of(side, origin):
        return orders.where(F.col("o_orderkey") % 2 == side).select(
            "o_orderkey", "o_custkey", F.lit(origin).alias("origin")
        )

    return joins.with_fallback(of(0, "primary"), of(1, "fallback"), ["o_custkey"])


@query(
    "replace_edition",
    """
    WITH old AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS edition, 'old' AS version FROM orders),
    new AS (SELECT l_orderkey, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS edition, 'new' AS version FROM lineitem
            WHERE l_shipdate >= TIMESTAMP '2000-01-01')
    SELECT * FROM old WHERE edition NOT IN (SELECT edition FROM new) UNION ALL SELECT * FROM new
    """,
)
def replace_edition(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("edition"), F.lit("old").alias("version")
    )
    new = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp"))
        .select(
            F.col("l_orderkey").alias("o_orderkey"),
            F.col("l_suppkey").alias("o_custkey"),
            F.year("l_shipdate").alias("edition"),
            F.lit("new").alias("version"),
        )
    )
    return joins.replace_groups(old, new, ["edition"])


@query(
    "csv_source_order",
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders
    """,
)
def csv_source_order(spark, sf_dir):
    """Positions of exported rows: sorted CSV part files, scanned back in file order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    sources.export_csv(orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey"), path)
    scanned = sources.scan_csv(spark, path, with_order=True)
    placed = number_rows(scanned, [], sources.SOURCE_ORDER)
    return placed.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "position")


_STORED = T.StructType(
    [T.StructField("series", T.StringType()), T.StructField("edition", T.IntegerType()), T.StructField("row_no", T.LongType()), T.StructField("price", T.DoubleType())]
)


def _stored_orders(spark, sf_dir):
    """Orders written by edition in order of their keys; the newest editions then replaced, and one of them in falling order."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("series"), F.year("o_orderdate").alias("edition"), F.col("o_orderkey").alias("row_no"), F.col("o_totalprice").alias("price")
    )
    path = f"{shared_folder(spark)}/ordered-{uuid.uuid4().hex}"
    sources.write_table(rows, path, sort_by=["row_no"])
    sources.replace_editions(rows.where("edition = 2000"), path, sort_by=["row_no"])
    falling = rows.where("edition = 1995 AND series = 'O'").hint("rebalance", "series", "edition").sortWithinPartitions("series", "edition", F.col("row_no").desc())
    falling.write.partitionBy("series", "edition").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return path


@query(
    "written_order_faults",
    """
    SELECT o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS edition, count(*) AS rows,
           CASE WHEN year(o_orderdate) = 1995 AND o_orderstatus = 'O' THEN count(*) - 1 ELSE 0 END AS faults
    FROM orders GROUP BY o_orderstatus, year(o_orderdate)
    """,
)
def written_order_faults(spark, sf_dir):
    """Rows out of order in a written table, in editions replaced in it, and in one that is stored the wrong way round."""
    return order_faults(spark, _stored_orders(spark, sf_dir), _STORED, ["row_no"])


@query(
    "dataset_outcomes",
    """
    SELECT 'good.csv' AS name, 'done' AS outcome, count(*) AS rows FROM orders
    UNION ALL SELECT 'missing.csv', 'missing', NULL UNION ALL SELECT 'broken.csv', 'failed', NULL
    UNION ALL SELECT 'open.csv', 'failed', NULL
    """,
)
def dataset_outcomes(spark, sf_dir):
    """Exports normalised side by side: a good one, one that is missing, one without a header, and one that ends inside quotes."""
    root = f"{shared_folder(spark)}/exports-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("string").alias("Year"), F.col("o_orderkey").cast("string").alias("Rank"))
    sources.export_csv(orders, f"{root}/good.csv")
    orders.limit(0).select(F.lit("").alias("value")).coalesce(1).write.text(f"{root}/broken.csv")
    open_cell = table(spark, sf_dir, "region").agg(F.concat(F.lit('Year,Rank\n1,"'), F.min("r_name")).alias("value"))
    open_cell.coalesce(1).write.text(f"{root}/open.csv")
    names = ("good.csv", "missing.csv", "broken.csv", "open.csv")
    jobs = export_jobs(spark, root, f"{root}/out", {name: {"Year": Role.KEY | Role.WHOLE, "Rank": Role.KEY | Role.WHOLE} for name in names})
    found = outcome_table(spark, run_side_by_side(spark, jobs))
    written = spark.read.option("header", True).csv(f"{root}/out/good.csv").agg(F.lit("good.csv").alias("name"), F.count(F.lit(1)).alias("rows"))
    return found.join(written, "name", "left").select("name", "outcome", "rows")


@query(
    "shipping_overlaps",
    """
    SELECT o.o_orderstatus AS status, o.quarter, count(*) AS pairs
    FROM (SELECT DISTINCT o_orderstatus, year(o_orderdate) * 4 + quarter(o_orderdate) AS quarter,
                 min(o_orderkey) OVER (PARTITION BY o_orderstatus, year(o_orderdate), quarter(o_orderdate)) AS low,
                 min(o_orderkey) OVER (PARTITION BY o_orderstatus, year(o_orderdate), quarter(o_orderdate)) + 100 + 50 * quarter(o_orderdate) AS high
          FROM orders) o
    JOIN (SELECT l_orderkey AS a, l_orderkey + l_quantity AS b FROM lineitem) l ON o.low < l.b AND o.high > l.a
    GROUP BY 1, 2
    """,
)
def shipping_overlaps(spark, sf_dir):
    """Many periods against many ranges: lines as ranges of keys, quarters of a status as periods of keys."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    quarter = (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("quarter")
    periods = orders.groupBy(F.col("o_orderstatus").alias("status"), quarter, F.quarter("o_orderdate").alias("q")).agg(F.min("o_orderkey").alias("low"))
    periods = periods.select("status", "quarter", "low", (F.col("low") + 100 + 50 * F.col("q")).alias("high"))
    ranges = lines.select(F.col("l_orderkey").alias("a"), (F.col("l_orderkey") + F.col("l_quantity")).alias("b"))
    found = overlaps(ranges, periods, "a", "b", "low", "high", 100)
    return found.groupBy("status", "quarter").agg(F.count(F.lit(1)).alias("pairs"))
