"""Number, duration and text columns, and cleaning of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from legwise.functions import durations as D
from legwise.functions import numbers as N
from legwise.functions import text as X
from legwise.operators import clean, normalise
from legwise.schema import Role
from spark_queries import views
from spark_queries.registry import query
from spark_queries.views import columns_of, table

# --- numbers ----------------------------------------------------------------


@query(
    "round_half_even",
    "SELECT o_orderkey, CAST(round_even(floor(o_totalprice) / 2, 0) AS BIGINT) AS rounded FROM orders",
)
def round_half_even(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", N.round_half_even(F.floor("o_totalprice") / 2).alias("rounded")
    )


@query(
    "coerce_numbers",
    """
    SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN CAST(o_custkey AS DOUBLE)
        WHEN 'O' THEN CASE WHEN o_custkey % 2 = 0 THEN o_custkey * 1000.0::DOUBLE END END AS number
    FROM orders
    """,
)
def coerce_numbers(spark, sf_dir):
    """Blanks and exponents are read; a suffix, a word or NaN make the value missing."""
    key = F.col("o_custkey").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("  "), key, F.lit(".0 ")))
        .when(
            F.col("o_orderstatus") == "O",
            F.when(F.col("o_custkey") % 2 == 0, F.concat(key, F.lit("e3"))).otherwise("NaN"),
        )
        .otherwise(F.concat(key, F.lit("d")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", N.to_number(text).alias("number"))


@query(
    "format_leg_number",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, CASE
        WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
        WHEN l_returnflag <> 'R' THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.' || l_linenumber
        END AS leg_text
    FROM lineitem
    """,
)
def format_leg_number(spark, sf_dir):
    whole = F.col("l_quantity").cast("bigint").cast("string")
    text = (
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("string"))
        .when(F.col("l_returnflag") != "R", F.concat_ws(".", whole, F.col("l_linenumber").cast("string")))
        .otherwise("x")
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", N.leg_number_text(text).alias("leg_text")
    )


@query(
    "canonical_cells",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR)
        WHEN 'O' THEN '' ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS cell,
      trim(o_orderpriority) AS priority
    FROM orders
    """,
)
def canonical_cells(spark, sf_dir):
    status = F.col("o_orderstatus")
    cell = (
        F.when(status == "F", F.concat(F.lit(" 0"), F.col("o_custkey").cast("string"), F.lit(".00")))
        .when(status == "O", F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("o_orderkey").cast("string"), F.lit(".50 ")))
    )
    priority = F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" "))
    return columns_of(
        spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    ).select(
        "o_orderkey", N.canonical(cell).alias("cell"), N.canonical(priority).alias("priority")
    )


# --- durations ---------------------------------------------------------------

_SECONDS = "CAST(floor(l_extendedprice) AS BIGINT)"


@query(
    "duration_roundtrip",
    f"""
    SELECT l_orderkey, l_linenumber, {_SECONDS} AS seconds,
           printf('%02dh %02d'' %02d''''', {_SECONDS} // 3600, {_SECONDS} % 3600 // 60, {_SECONDS} % 60) AS printed,
           {_SECONDS} AS parsed
    FROM lineitem
    """,
)
def duration_roundtrip(spark, sf_dir):
    seconds = F.floor("l_extendedprice")
    return (
        columns_of(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
        .select("l_orderkey", "l_linenumber", seconds.alias("seconds"))
        .withColumn("printed", D.duration_text(F.col("seconds")))
        .withColumn("parsed", D.duration_seconds(F.col("printed")))
    )


@query(
    "duration_forms",
    """
    WITH parts AS (SELECT o_orderkey, o_orderpriority, o_custkey % 24 AS h, o_custkey % 60 AS m,
                          o_orderkey % 60 AS s FROM orders)
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN h * 3600 + m * 60
        WHEN '2-HIGH' THEN 0
        WHEN '3-MEDIUM' THEN h * 3600 + s
        WHEN '4-NOT SPECIFIED' THEN h * 3600 + m * 60 + s
        ELSE 0 END AS seconds
    FROM parts
    """,
)
def duration_forms(spark, sf_dir):
    """Left-out seconds, bare hours, a minus inside, clock times and words."""
    priority = F.col("o_orderpriority")
    h, m, s = F.col("o_custkey") % 24, F.col("o_custkey") % 60, F.col("o_orderkey") % 60
    text = (
        F.when(priority == "1-URGENT", F.format_string("%dh%02d", h, m))
        .when(priority == "2-HIGH", F.format_string("%dh", h))
        .when(priority == "3-MEDIUM", F.format_string("+ %dh -' %02d''", h, s))
        .when(priority == "4-NOT SPECIFIED", F.format_string("%02d:%02d:%02d", h, m, s))
        .otherwise("not a time")
    )
    return columns_of(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority").select("o_orderkey", D.duration_seconds(text).alias("seconds"))


@query(
    "gap_plausibility",
    """
    SELECT o_orderkey, CASE WHEN floor(o_totalprice) > 180000 THEN 0
                            ELSE CAST(floor(o_totalprice) AS BIGINT) END AS gap_seconds
    FROM orders
    """,
)
def gap_plausibility(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", D.plausible_gap(F.floor("o_totalprice")).alias("gap_seconds")
    )


@query(
    "format_duration",
    """
    SELECT o_orderkey, printf('%02dh %02d'' %02d''''', o_orderkey // 3600, o_orderkey % 3600 // 60, o_orderkey % 60) AS printed
    FROM orders
    """,
)
def format_duration(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", D.duration_text(F.col("o_orderkey")).alias("printed")
    )


@query(
    "format_gap",
    """
    SELECT o_orderkey, CASE WHEN o_custkey % 10 = 0 THEN '-' ELSE
      printf('+ %02dh %02d'' %02d''''', g // 3600, g % 3600 // 60, g % 60) END AS gap
    FROM (SELECT *, o_custkey % 10 * 977 AS g FROM orders)
    """,
)
def format_gap(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", D.gap_text(F.col("o_custkey") % 10 * 977).alias("gap")
    )


@query(
    "format_margin",
    """
    SELECT o_orderkey,
      CASE WHEN o_custkey < 120 THEN o_custkey || ' seconds' ELSE o_custkey // 60 || ' minutes' END AS long_text,
      CASE WHEN o_custkey < 60 THEN o_custkey || '''''' ELSE printf('%d''%02d''''', o_custkey // 60, o_custkey % 60) END AS short_text
    FROM orders
    """,
)
def format_margin(spark, sf_dir):
    seconds = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        D.margin_text(seconds).alias("long_text"),
        D.margin_text_short(seconds).alias("short_text"),
    )


# --- text --------------------------------------------------------------------


@query(
    "title_case_names",
    r"""
    SELECT doc_id, array_to_string(list_transform(
      regexp_extract_all(text, '[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+'),
      lambda w: CASE substr(w, 1, 1) WHEN 'ß' THEN 'Ss' ELSE upper(substr(w, 1, 1)) END || lower(substr(w, 2))), '') AS titled
    FROM documents
    """,
)
def title_case_names(spark, sf_dir):
    """Whole documents in title case."""
    return columns_of(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", X.title_case(F.col("text")).alias("titled"))


@query(
    "title_case_columns",
    """
    SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2, strpos(p_name, ' ') - 1)
             || upper(substr(p_name, strpos(p_name, ' ') + 1, 1)) || substr(p_name, strpos(p_name, ' ') + 2) AS winner_name,
           p_name
    FROM part
    """,
)
def title_case_columns(spark, sf_dir):
    """Only columns named after winners or jerseys change."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("winner_name"), "p_name")
    return clean.title_case_columns(parts)


@query(
    "leg_number_parse",
    """
    SELECT o_orderkey, CASE o_orderpriority
        WHEN '1-URGENT' THEN CAST(o_custkey AS DOUBLE)
        WHEN '2-HIGH' THEN CAST(o_custkey || '.' || (o_orderkey % 9 + 1) AS DOUBLE)
        WHEN '3-MEDIUM' THEN 0.0 END AS leg
    FROM orders
    """,
)
def leg_number_parse(spark, sf_dir):
    priority, key = F.col("o_orderpriority"), F.col("o_custkey").cast("string")
    label = (
        F.when(priority == "1-URGENT", F.concat(F.lit("Stage "), key, F.lit(" : A > B")))
        .when(
            priority == "2-HIGH",
            F.concat(F.lit("Stage "), key, F.lit("."), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit(" : A > B")),
        )
        .when(priority == "3-MEDIUM", F.lit("Prologue 1.5 : A > A"))
        .when(priority == "5-LOW", F.concat(F.lit("Stage "), key, F.lit("d : A > B")))
        .otherwise("garbage")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", X.leg_number(label).alias("leg"))


@query(
    "split_route_text",
    """
    SELECT p_partkey, CAST(p_size AS DOUBLE) AS leg, p_name AS start,
           CASE WHEN p_type <> 'SMALL' THEN p_brand END AS "end"
    FROM part
    """,
)
def split_route_text(spark, sf_dir):
    """Number, start and end; a second colon ends the route, a missing separator is NULL."""
    tail = F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(
        F.concat(F.lit(" >  "), F.col("p_brand"), F.lit(" : "), F.col("p_type"))
    )
    label = F.concat(
        F.lit("Stage "), F.col("p_size").cast("string"), F.lit(" :  "), F.col("p_name"), tail
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        X.leg_number(label).alias("leg"),
        X.route_part(label, 0).alias("start"),
        X.route_part(label, 1).alias("end"),
    )


# --- results -----------------------------------------------------------------


@query(
    "classify_editions",
    f"WITH {views.RESULTS} SELECT series, edition, row_no, result_type FROM typed",
)
def classify_editions(spark, sf_dir):
    printed = views.results(spark, sf_dir)
    return printed.select(
        "series", "edition", "row_no", clean.result_type(F.col("edition")).alias("result_type")
    )


@query(
    "zero_untimed",
    f"""
    WITH {views.RESULTS}
    SELECT series, edition, row_no, result_type, CAST(own_seconds AS BIGINT) AS total_seconds,
           CAST(gap_seconds AS BIGINT) AS gap_seconds FROM timed
    """,
)
def zero_untimed(spark, sf_dir):
    """Parsed seconds, zeroed where the edition was not decided on time."""
    parsed = clean.with_seconds(views.results(spark, sf_dir)).withColumn(
        "result_type", clean.result_type(F.col("edition"))
    )
    zeroed = clean.zero_unless_timed(parsed, ["total_seconds", "gap_seconds"])
    return zeroed.select("series", "edition", "row_no", "result_type", "total_seconds", "gap_seconds")


@query(
    "attach_leg_counts",
    f"""
    WITH {views.RESULTS}, {views.RESULT_LEGS}
    SELECT p.series, p.edition, row_no, CAST(n AS INTEGER) AS leg_count FROM printed p
    JOIN (SELECT series, edition, count(*) AS n FROM result_legs GROUP BY 1, 2) c
      ON c.series = p.series AND c.edition = p.edition
    """,
)
def attach_leg_counts(spark, sf_dir):
    printed = views.results(spark, sf_dir).select("series", "edition", "row_no")
    return clean.with_leg_counts(printed, views.result_legs(spark, sf_dir))


@query(
    "rebase_totals",
    """
    WITH seconds AS (SELECT o_orderkey AS row_no, o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS edition,
           CAST(floor(o_totalprice) AS BIGINT) AS total_seconds, o_custkey AS gap_seconds FROM orders)
    SELECT * EXCLUDE (total_seconds), CASE WHEN edition = 1997 AND row_no <> min(row_no) OVER w
        THEN first_value(total_seconds) OVER (w ORDER BY row_no) + gap_seconds ELSE total_seconds END AS total_seconds
    FROM seconds WINDOW w AS (PARTITION BY series, edition)
    """,
)
def rebase_totals(spark, sf_dir):
    seconds = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_no"),
        F.col("o_orderstatus").alias("series"),
        F.year("o_orderdate").alias("edition"),
        F.floor("o_totalprice").alias("total_seconds"),
        F.col("o_custkey").alias("gap_seconds"),
    )
    return clean.rebase_from_leader(seconds, ["row_no"])


@query(
    "override_zero_values",
    f"""
    WITH {views.RESULTS}
    SELECT series, edition, row_no, CASE WHEN series = 'F' AND edition = 1997 THEN 3950 ELSE distance END AS distance FROM typed
    """,
)
def override_zero_values(spark, sf_dir):
    overrides = spark.createDataFrame(
        [("F", 1997, 3950), ("F", 1998, 1)], "series string, edition int, override int"
    )
    printed = views.results(spark, sf_dir).select("series", "edition", "row_no", "distance")
    return clean.apply_overrides(printed, "distance", overrides)


@query(
    "clean_results",
    f"""
    WITH {views.RESULTS}, {views.RESULT_LEGS}
    SELECT r.series, r.edition, row_no, rank_text, participant, team, distance, result_type,
           CAST(n AS INTEGER) AS leg_count, CAST(total_seconds AS BIGINT) AS total_seconds,
           CAST(gap_seconds AS BIGINT) AS gap_seconds
    FROM results r JOIN (SELECT series, edition, count(*) AS n FROM result_legs GROUP BY 1, 2) c
      ON c.series = r.series AND c.edition = r.edition
    """,
)
def clean_results(spark, sf_dir):
    """Types, leg counts, seconds and rebased totals for all editions in one plan."""
    cleaned = clean.clean_results(views.results(spark, sf_dir), views.result_legs(spark, sf_dir))
    return cleaned.drop("times", "gap")


@query(
    "drop_empty_columns",
    """
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS debt FROM customer
    """,
)
def drop_empty_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.nullif("c_mktsegment", "c_mktsegment").alias("white_jersey"),
        F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("debt"),
    )
    return clean.drop_empty_columns(customers)


# --- normalising tables ------------------------------------------------------


def _texts(spark, sf_dir):
    items = columns_of(
        spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_tax", "l_returnflag", "l_linestatus",
    )
    return items.select(
        F.col("l_orderkey").cast("string").alias("Key"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("Year"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("string")).alias("Rank"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7), "DSQ")
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("Rider No."),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("."), (F.col("l_suppkey") % 2).cast("string")).alias("Stages"),
        F.col("l_tax").cast("string").alias("Tax"),
    )


@query(
    "lossless_int_check",
    """
    SELECT unnest(['Year', 'Rank', 'Rider No.', 'Stages', 'Tax']) AS column_name,
           unnest([true, true, count(*) FILTER (WHERE l_linestatus = 'O' AND l_linenumber = 7) = 0,
                   count(*) FILTER (WHERE l_suppkey % 2 = 1) = 0, count(*) FILTER (WHERE l_tax <> floor(l_tax)) = 0]) AS lossless
    FROM lineitem
    """,
)
def lossless_int_check(spark, sf_dir):
    columns = ["Year", "Rank", "Rider No.", "Stages", "Tax", "absent"]
    return normalise.lossless_int_check(_texts(spark, sf_dir), columns)


@query(
    "normalise_table",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS "Key", CAST(l_linenumber AS BIGINT) AS "Year",
           CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END AS "Rank",
           CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN 'DSQ' ELSE CAST(l_partkey AS VARCHAR) END AS "Rider No.",
           l_linenumber || CASE WHEN l_suppkey % 2 = 1 THEN '.1' ELSE '' END AS "Stages"
    FROM lineitem
    """,
)
def normalise_table(spark, sf_dir):
    """Whole-number columns become integers, the one holding a word stays, legs are minimal text."""
    roles = {"Year": Role.KEY | Role.WHOLE, "Rank": Role.KEY | Role.WHOLE, "Rider No.": Role.WHOLE, "Stages": Role.LEG}
    return normalise.apply_roles(_texts(spark, sf_dir).drop("Tax"), roles)


@query(
    "whole_numbers_exact",
    """
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber % 5 WHEN 0 THEN 9007199254740993 + l_partkey WHEN 1 THEN CAST(l_partkey AS BIGINT)
                WHEN 2 THEN CAST(l_partkey * 1000 AS BIGINT) END AS value
    FROM lineitem
    """,
)
def whole_numbers_exact(spark, sf_dir):
    """Whole numbers of 16 digits, with zeros behind the point and with exponents; fractions and words are none."""
    part, line = F.col("l_partkey"), F.col("l_linenumber") % 5
    text = (
        F.when(line == 0, (part + 9007199254740993).cast("string"))
        .when(line == 1, F.concat(F.lit(" +"), part.cast("string"), F.lit(".00 ")))
        .when(line == 2, F.concat(part.cast("string"), F.lit("e3")))
        .when(line == 3, F.concat(part.cast("string"), F.lit(".5")))
        .otherwise(F.concat(F.lit("9223372036854775808"), part.cast("string")))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.whole_number(text).alias("value"))
