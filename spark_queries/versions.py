"""Versions of tables that change as one, on two tables made of orders and their lines."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from legwise.operators import coverage
from legwise.sources import versions
from legwise.staging import shared_folder, stage
from spark_queries.registry import query
from spark_queries.views import table

_KEYS = T.StructType().add("series", "string").add("edition", "integer").add("row_no", "long")
SCHEMAS = {
    "results": T.StructType([*_KEYS, T.StructField("price", T.DoubleType())]),
    "lines": T.StructType([*_KEYS, T.StructField("line", T.LongType()), T.StructField("quantity", T.DoubleType())]),
}
SORTED_BY = {"results": ["row_no"], "lines": ["row_no", "line"]}

# What the second state lacks or has otherwise: an edition gone, one with other prices, one with a row more.
_STATES = """
WITH old_results AS (
  SELECT o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS edition, o_orderkey AS row_no, o_totalprice AS price FROM orders),
new_results AS (
  SELECT series, edition, row_no, CASE WHEN edition = 1996 AND row_no % 8 = 1 THEN price + 1 ELSE price END AS price
  FROM old_results WHERE NOT (series = 'F' AND edition = 1997)
  UNION ALL SELECT 'O', 1998, -1, 0.5),
old_lines AS (
  SELECT l_linestatus AS series, CAST(year(l_shipdate) AS INTEGER) AS edition, l_orderkey AS row_no, CAST(l_linenumber AS BIGINT) AS line,
         l_quantity AS quantity FROM lineitem),
new_lines AS (SELECT * FROM old_lines WHERE NOT (edition = 1999 AND quantity = 50))
"""


def states(spark, sf_dir):
    """The tables as they were, and a state with rows gone, altered and added."""
    results = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("series"), F.year("o_orderdate").alias("edition"), F.col("o_orderkey").alias("row_no"), F.col("o_totalprice").alias("price")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("series"), F.year("l_shipdate").alias("edition"), F.col("l_orderkey").alias("row_no"),
        F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_quantity").cast("double").alias("quantity"),
    )
    dearer = F.when((F.col("edition") == 1996) & (F.col("row_no") % 8 == 1), F.col("price") + 1).otherwise(F.col("price"))
    kept = results.where(~((F.col("series") == "F") & (F.col("edition") == 1997))).withColumn("price", dearer)
    extra = spark.createDataFrame([("O", 1998, -1, 0.5)], results.schema)
    fewer = lines.where(~((F.col("edition") == 1999) & (F.col("quantity") == 50)))
    return {"results": results, "lines": lines}, {"results": kept.unionByName(extra), "lines": fewer}


def _changes(root, state):
    return {name: versions.compare(stage(df, name), SCHEMAS[name], name, root) for name, df in state.items()}


def _second_version(spark, sf_dir):
    """A root with both states committed, one after the other."""
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    for state in states(spark, sf_dir):
        versions.commit(spark, root, _changes(root, state), versions.current(spark, root), SORTED_BY)
    return root


@query("current_version", f"{_STATES} SELECT * FROM new_results")
def current_version(spark, sf_dir):
    """What readers see after two versions; unchanged editions are still those of the first."""
    root = _second_version(spark, sf_dir)
    return versions.read(spark, root, "results", SCHEMAS["results"])


@query(
    "editions_taken_over",
    f"""{_STATES}
    SELECT 'results' AS "table", series, edition, count(*) AS rows,
           NOT (edition = 1996 AND bool_or(row_no % 8 = 1) OR series = 'O' AND edition = 1998) AS taken_over
    FROM new_results GROUP BY series, edition
    UNION ALL
    SELECT 'lines', n.series, n.edition, n.rows, n.rows = o.rows
    FROM (SELECT series, edition, count(*) AS rows FROM new_lines GROUP BY ALL) n
    JOIN (SELECT series, edition, count(*) AS rows FROM old_lines GROUP BY ALL) o USING (series, edition)
    """,
)
def editions_taken_over(spark, sf_dir):
    """Editions of the second version, and whether their rows are still those the first one wrote."""
    root = _second_version(spark, sf_dir)
    last = versions.current(spark, root)
    return versions.editions(spark, root, last).select(
        "table", "series", "edition", "rows", (F.col("held_by") != last.version).alias("taken_over")
    )


def _lost_sql(name: str, columns: str) -> str:
    return f"""
    SELECT '{name}' AS "table", series, edition, CAST(sum(missing) AS BIGINT) AS lost_rows FROM (
      SELECT series, edition, sum(n) AS missing FROM (
        SELECT *, 1 AS n FROM old_{name} UNION ALL SELECT *, -1 FROM new_{name}) GROUP BY series, edition, {columns} HAVING sum(n) > 0)
    GROUP BY series, edition"""


@query("lost_rows_by_table", f"{_STATES} {_lost_sql('results', 'row_no, price')} UNION ALL {_lost_sql('lines', 'row_no, line, quantity')}")
def lost_rows_by_table(spark, sf_dir):
    """How many rows of each edition a new state would remove or alter; only editions that differ are read again."""
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    old, new = states(spark, sf_dir)
    versions.commit(spark, root, _changes(root, old), None, SORTED_BY)
    found = [
        change.lost.groupBy("series", F.col("edition").cast("int").alias("edition")).agg(F.sum("missing_count").alias("lost_rows"))
        .select(F.lit(name).alias("table"), "series", "edition", "lost_rows")
        for name, change in _changes(root, new).items()
    ]
    return found[0].unionByName(found[1])


@query("damaged_editions", "SELECT o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS edition, count(*) AS rows FROM orders WHERE year(o_orderdate) = 1995 AND o_orderstatus = 'O' GROUP BY ALL")
def damaged_editions(spark, sf_dir):
    """Editions whose stored rows are no longer those that were committed: one file is written over by another job."""
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    first, _ = states(spark, sf_dir)
    first = {"results": first["results"]}
    last = versions.commit(spark, root, _changes(root, first), None, SORTED_BY)
    spoilt = first["results"].where("series = 'O' AND edition = 1995").select("row_no", (F.col("price") * 2).alias("price"))
    spoilt.write.mode("overwrite").parquet(f"{root}/results/version={last.version}/series=O/edition=1995")
    return versions.damaged(spark, root, "results", SCHEMAS["results"])


@query(
    "coverage_from_states",
    f"""{_STATES}
    SELECT series, min(edition) AS first_edition, max(edition) AS latest_edition, CAST(count(DISTINCT edition) AS INTEGER) AS editions,
           max(edition) - min(edition) AS span_years
    FROM new_results GROUP BY series
    """,
)
def coverage_from_states(spark, sf_dir):
    """Coverage after two versions, merged from bitmaps; the second version reads the rows of its changed editions only."""
    root = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    for state in states(spark, sf_dir):
        replaces, changes = versions.current(spark, root), _changes(root, {"results": state["results"]})
        summed = versions.summed_up(spark, root, "results", changes["results"], replaces, coverage.states, coverage.STATES)
        versions.commit(spark, root, changes, replaces, SORTED_BY, states={"results": summed})
    return coverage.from_states(summed.every)
