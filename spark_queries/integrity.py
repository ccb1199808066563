"""Comparing versions of a table, and generated text in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from legwise.operators import integrity, textblocks
from spark_queries.registry import query
from spark_queries.views import columns_of, table

_VERSIONS = """
WITH old AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS status, CAST(year(o_orderdate) * 10000 + 101 AS VARCHAR) AS edition FROM orders
),
new AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'X' ELSE o_orderstatus END AS status,
         CAST(year(o_orderdate) * 10000 + 101 AS VARCHAR) AS edition FROM orders WHERE o_totalprice >= 20000
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, '' FROM customer
)
"""


def _versions(spark, sf_dir):
    """Orders as they were, and a version with altered, lost and added rows and other spellings."""
    orders = table(spark, sf_dir, "orders")
    old = orders.select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderstatus").alias("status"),
        (F.year("o_orderdate") * 10000 + 101).alias("edition"),
    )
    altered = F.when(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), "X"
    ).otherwise(F.col("o_orderstatus"))
    kept = orders.where(F.col("o_totalprice") >= 20000).select(
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("customer"),
        F.concat(altered, F.lit("  ")).alias("status"),
        (F.year("o_orderdate") * 10000 + 101).cast("double").alias("edition"),
    )
    added = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer"),
        F.col("c_mktsegment").alias("status"),
        F.lit(None).cast("double").alias("edition"),
    )
    return old, kept.unionByName(added)


def _difference(first: str, second: str) -> str:
    return f"""{_VERSIONS}
    SELECT customer, status, edition, CAST(sum(n) AS BIGINT) AS missing_count FROM (
      SELECT *, 1 AS n FROM {first} UNION ALL SELECT *, -1 FROM {second}
    ) GROUP BY 1, 2, 3 HAVING sum(n) > 0
    """


@query("integrity_missing_rows", _difference("old", "new"))
def integrity_missing_rows(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    return integrity.missing_rows(old, new, old.columns)


@query("integrity_added_rows", _difference("new", "old"))
def integrity_added_rows(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    return integrity.missing_rows(new, old, old.columns)


# --- marked blocks -----------------------------------------------------------

_MARKED = r"""
WITH marked AS (
  SELECT doc_id, CASE lang
    WHEN 'de' THEN text
    WHEN 'fr' THEN text || chr(10) || '<!-- note:start -->' || chr(10) || 'a\1$0' || chr(10) || '<!-- note:end -->'
    ELSE 'x' || chr(10) || '<!-- note:start -->' || chr(10) || text || chr(10) || '<!-- note:end -->' || source END AS text,
    CASE lang
    WHEN 'de' THEN text
    WHEN 'fr' THEN text || chr(10) || '<!-- note:start -->' || chr(10) || 'a\1$0' || chr(10) || '<!-- note:end -->'
    ELSE 'x' || chr(10) || '<!-- note:start -->' || chr(10) || 'a\1$0' || chr(10) || '<!-- note:end -->' || source END AS updated_text,
    lang <> 'de' AS has_marker
  FROM documents
)
"""


def _marked(spark, sf_dir):
    """Documents without marks, with an up-to-date block, and with their text inside the block."""
    start, end = "\n<!-- note:start -->\n", "\n<!-- note:end -->"
    text = F.col("text")
    wrapped = (
        F.when(F.col("lang") == "de", text)
        .when(F.col("lang") == "fr", F.concat(text, F.lit(start + "a\\1$0" + end)))
        .otherwise(F.concat(F.lit("x" + start), text, F.lit(end), F.col("source")))
    )
    return columns_of(spark, sf_dir, "documents", "doc_id", "text", "lang", "source").select("doc_id", wrapped.alias("text"))


@query(
    "replace_marked_block",
    f"{_MARKED} SELECT doc_id, has_marker, updated_text, updated_text <> text AS changed FROM marked",
)
def replace_marked_block(spark, sf_dir):
    marked = _marked(spark, sf_dir)
    return textblocks.refresh_blocks(marked, "text", F.lit("a\\1$0"), "note").drop("text")


@query(
    "stale_documents",
    f"{_MARKED} SELECT doc_id, has_marker, updated_text <> text AS changed FROM marked WHERE updated_text <> text OR NOT has_marker",
)
def stale_documents(spark, sf_dir):
    """Check mode: documents that are out of date or have no marks."""
    stale = textblocks.stale_documents(_marked(spark, sf_dir), "text", F.lit("a\\1$0"), "note")
    return stale.select("doc_id", "has_marker", "changed")
