"""Rebuilding standings, ranking and order."""

from __future__ import annotations

from pyspark.sql import functions as F

from legwise.operators import standings
from legwise.operators.normalise import numeric_positions
from legwise.operators.ordering import carry_forward, first_k, number_rows
from legwise.schema import Role
from spark_queries import views
from spark_queries.registry import query
from spark_queries.views import table

_GATE = f"""
WITH {views.LEG_LISTINGS}, {views.KNOWN_STANDINGS}, {views.LEGS},
gate AS (
  SELECT n.series, n.edition, coalesce(k.edition, 0) AS known_edition
  FROM (SELECT series, max(edition) AS edition FROM leg_listings GROUP BY 1) n
  LEFT JOIN (SELECT series, max(edition) AS edition FROM known_standings GROUP BY 1) k USING (series)
  WHERE n.edition > coalesce(k.edition, 0)
)"""

_REBUILT = f"""{_GATE},
distances AS (
  SELECT series, edition, arg_min(total_distance, row_no) AS distance FROM legs GROUP BY 1, 2
),
totals AS (
  SELECT series, edition, participant, count(DISTINCT leg) AS ridden, sum(total_seconds) AS total,
         first(team ORDER BY leg, row_no, line, supplier) FILTER (WHERE team IS NOT NULL) AS team
  FROM leg_listings JOIN gate USING (series, edition) GROUP BY 1, 2, 3
),
complete AS (
  SELECT * FROM (SELECT *, max(ridden) OVER (PARTITION BY series, edition) AS needed FROM totals)
  WHERE ridden = needed
),
ranked AS (
  SELECT *, row_number() OVER w AS rank, total - min(total) OVER (PARTITION BY series, edition) AS behind
  FROM complete WINDOW w AS (PARTITION BY series, edition ORDER BY total, participant)
),
rebuilt AS (
  SELECT series, edition, CAST(rank AS INTEGER) AS rank, participant, team,
         printf('%02dh %02d'' %02d''''', total // 3600, total % 3600 // 60, total % 60) AS times,
         CASE WHEN behind = 0 THEN '-' ELSE
           '+ ' || printf('%02dh %02d'' %02d''''', behind // 3600, behind % 3600 // 60, behind % 60) END AS gap,
         CAST(coalesce(distance, 0) AS INTEGER) AS distance, CAST(needed AS INTEGER) AS leg_count,
         'time' AS result_type, CAST(total AS BIGINT) AS total_seconds, CAST(behind AS BIGINT) AS gap_seconds,
         true AS provisional
  FROM ranked LEFT JOIN distances USING (series, edition)
)"""


def rebuilt(spark, sf_dir):
    return standings.rebuild(
        views.leg_listings(spark, sf_dir),
        views.known_standings(spark, sf_dir),
        views.legs(spark, sf_dir),
        order=views.LISTING_ORDER,
        distinct_legs=True,
    ).drop("row_no", "rank_text", "bib", "bonus", "penalty")


@query("rebuild_standings", f"{_REBUILT} SELECT * FROM rebuilt")
def rebuild_standings(spark, sf_dir):
    """Standings of the newest editions from their leg rankings."""
    return rebuilt(spark, sf_dir)


@query(
    "rebuild_winner",
    f"{_REBUILT} SELECT series, edition, participant, times FROM rebuilt WHERE rank = 1",
)
def rebuild_winner(spark, sf_dir):
    return rebuilt(spark, sf_dir).where(F.col("rank") == 1).select(
        "series", "edition", "participant", "times"
    )


@query(
    "rebuilt_union",
    f"""{_REBUILT}
    SELECT series, edition, participant, NULL::INTEGER AS rank, NULL::BIGINT AS total_seconds FROM known_standings
    WHERE (series, edition) NOT IN (SELECT (series, edition) FROM rebuilt)
    UNION ALL SELECT series, edition, participant, rank, total_seconds FROM rebuilt
    """,
)
def rebuilt_union(spark, sf_dir):
    """Known standings with the rebuilt editions put in."""
    new = rebuilt(spark, sf_dir).select("series", "edition", "participant", "rank", "total_seconds")
    return standings.with_rebuilt(views.known_standings(spark, sf_dir), new)


@query("editions_to_rebuild", f"{_GATE} SELECT series, edition, known_edition FROM gate")
def editions_to_rebuild(spark, sf_dir):
    return standings.editions_to_rebuild(
        views.leg_listings(spark, sf_dir), views.known_standings(spark, sf_dir)
    )


@query(
    "complete_participants",
    f"""
    WITH {views.LEG_RANKINGS},
    counted AS (SELECT series, edition, participant, CAST(count(*) AS INTEGER) AS legs_ridden
                FROM leg_rankings GROUP BY 1, 2, 3)
    SELECT * FROM counted QUALIFY legs_ridden = max(legs_ridden) OVER (PARTITION BY series, edition)
    """,
)
def complete_participants(spark, sf_dir):
    return standings.complete_participants(views.leg_rankings(spark, sf_dir))


@query(
    "total_with_first_attr",
    f"""
    WITH {views.LEG_RANKINGS}
    SELECT series, edition, participant, CAST(count(*) AS INTEGER) AS legs_ridden,
           CAST(sum(total_seconds) AS BIGINT) AS total_seconds,
           arg_min(team, leg) FILTER (WHERE team IS NOT NULL) AS team
    FROM leg_rankings GROUP BY 1, 2, 3
    """,
)
def total_with_first_attr(spark, sf_dir):
    """Summed seconds and first known team per participant and edition."""
    return standings.participant_totals(views.leg_rankings(spark, sf_dir), order=["leg"])


@query(
    "numeric_sort_position",
    """
    SELECT o_orderkey, row_number() OVER (
             ORDER BY year(o_orderdate), CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 50 END NULLS LAST, o_orderkey
           ) AS position
    FROM orders
    """,
)
def numeric_sort_position(spark, sf_dir):
    """Position in numeric order of text keys; texts that are no numbers come last."""
    listed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("string").alias("Year"),
        F.when(F.col("o_orderstatus") == "P", "DSQ")
        .otherwise((F.col("o_custkey") % 50).cast("string"))
        .alias("Rank"),
    )
    spec = {"Year": Role.KEY, "Rank": Role.KEY}
    return numeric_positions(listed, spec, ["o_orderkey"]).select("o_orderkey", "position")


@query(
    "text_sort_position",
    """
    SELECT o_orderkey, row_number() OVER (
             ORDER BY year(o_orderdate), o_orderpriority, CAST(o_custkey AS VARCHAR), o_orderkey) AS position
    FROM orders
    """,
)
def text_sort_position(spark, sf_dir):
    """Position by edition, classification and rank, with the rank compared as text."""
    listed = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("edition"),
        "o_orderpriority",
        F.col("o_custkey").cast("string").alias("rank_text"),
    )
    keys = ["edition", "o_orderpriority", "rank_text", "o_orderkey"]
    return number_rows(listed, [], keys).select("o_orderkey", "position")


@query(
    "carry_forward_events",
    """
    SELECT event_id, user_id, event_type,
           last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (
             PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW
           ) AS checkpoint
    FROM events
    """,
)
def carry_forward_events(spark, sf_dir):
    """Every event with its user's latest signup event."""
    marked = table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        F.when(F.col("event_type") == "signup", F.col("event_id")).alias("signup"),
    )
    carried = carry_forward(marked, ["user_id"], ["ts", "event_id"], "signup", "checkpoint")
    return carried.select("event_id", "user_id", "event_type", "checkpoint")


@query(
    "newest_k_per_group",
    """
    SELECT o_custkey, o_orderkey, n FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS n
      FROM orders) WHERE n <= 5
    """,
)
def newest_k_per_group(spark, sf_dir):
    newest = first_k(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()],
        5,
        "n",
    )
    return newest.select("o_custkey", "o_orderkey", "n")
