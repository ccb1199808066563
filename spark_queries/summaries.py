"""Coverage, and the data behind the charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from legwise.operators import analytics, clean, coverage
from legwise.functions.numbers import to_number
from spark_queries import views
from spark_queries.registry import query


def cleaned(spark, sf_dir):
    return clean.timed_results(views.results(spark, sf_dir))


_COVERAGE = f"""
WITH {views.RESULTS},
coverage AS (
  SELECT series, min(edition) AS first_edition, max(edition) AS latest_edition,
         CAST(count(DISTINCT edition) AS INTEGER) AS editions, max(edition) - min(edition) AS span_years
  FROM printed GROUP BY 1
)"""


def _coverage(spark, sf_dir):
    return coverage.by_series(views.results(spark, sf_dir))


@query("coverage_by_series", f"{_COVERAGE} SELECT * FROM coverage")
def coverage_by_series(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query(
    "coverage_titles",
    f"""{_COVERAGE}
    SELECT series, 'Winning margin, ' || series || ' ' || first_edition || ' - ' || latest_edition AS title FROM coverage
    """,
)
def coverage_titles(spark, sf_dir):
    prefix = F.concat(F.lit("Winning margin, "), F.col("series"))
    return coverage.titles(_coverage(spark, sf_dir), prefix).select("series", "title")


@query(
    "coverage_sentences",
    f"""{_COVERAGE}
    SELECT series, '-   **Series ' || series || '**: ' || first_edition || ' - ' || latest_edition ||
      CASE WHEN series = 'O' THEN ' (all editions since the relaunch)' ELSE ' (all ' || editions || ' editions)' END AS sentence
    FROM coverage
    """,
)
def coverage_sentences(spark, sf_dir):
    named = F.concat(F.lit("Series "), F.col("series"))
    listed = coverage.sentences(_coverage(spark, sf_dir), named, F.col("series") == "O")
    return listed.select("series", "sentence")


@query(
    "coverage_page_head",
    f"""{_COVERAGE}
    SELECT '<title>Results — ' || f.span_years || ' years of race data</title>' || chr(10) ||
      '<meta name="description" content="Every rider and every stage of the First (' || f.first_edition || '–' || f.latest_edition ||
      ') and the Second (' || o.first_edition || '–' || o.latest_edition || ') in four CSV files. Explore the data live.">' AS head
    FROM coverage f, coverage o WHERE f.series = 'F' AND o.series = 'O'
    """,
)
def coverage_page_head(spark, sf_dir):
    return coverage.page_head(_coverage(spark, sf_dir), "F", "O", "Results", ("First", "Second"))


# --- charts ------------------------------------------------------------------

_WINNERS = f"""
WITH {views.RESULTS},
winners AS (
  SELECT * FROM results WHERE rank_number IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY series, edition ORDER BY rank_number, row_no) = 1
),
paces AS (
  SELECT r.series, r.edition, avg(r.distance) AS mean_distance,
         any_value(CASE WHEN w.total_seconds > 0 THEN w.distance / (w.total_seconds / 3600) END) AS winner_pace
  FROM results r LEFT JOIN winners w ON w.series = r.series AND w.edition = r.edition GROUP BY 1, 2
)"""


@query(
    "edition_winners",
    f"""{_WINNERS}
    SELECT series, edition, row_no, participant, rank_text, CAST(total_seconds AS BIGINT) AS total_seconds FROM winners
    """,
)
def edition_winners(spark, sf_dir):
    winners = analytics.edition_winners(cleaned(spark, sf_dir))
    return winners.select("series", "edition", "row_no", "participant", "rank_text", "total_seconds")


@query("mean_by_edition", f"{_WINNERS} SELECT series, edition, round(mean_distance, 6) AS mean_distance FROM paces")
def mean_by_edition(spark, sf_dir):
    means = analytics.mean_distance(views.results(spark, sf_dir))
    return means.withColumn("mean_distance", F.round("mean_distance", 6))


@query(
    "winner_pace",
    f"""{_WINNERS} SELECT series, edition, round(CASE WHEN total_seconds > 0 THEN distance / (total_seconds / 3600) END, 6) AS winner_pace
    FROM winners""",
)
def winner_pace(spark, sf_dir):
    paces = analytics.winner_pace(cleaned(spark, sf_dir))
    return paces.withColumn("winner_pace", F.round("winner_pace", 6))


@query(
    "distance_and_pace",
    f"{_WINNERS} SELECT series, edition, round(mean_distance, 6) AS mean_distance, round(winner_pace, 6) AS winner_pace FROM paces",
)
def distance_and_pace(spark, sf_dir):
    per_edition = analytics.distance_and_pace(cleaned(spark, sf_dir))
    return per_edition.withColumns({c: F.round(c, 6) for c in ("mean_distance", "winner_pace")})


@query(
    "chart_bounds",
    f"""{_WINNERS}
    SELECT series, min(edition) AS first_edition, max(edition) AS latest_edition, min(edition) - 2 AS axis_start,
           max(edition) + 2 AS axis_end, round(max(mean_distance) * 1.1, 6) AS distance_limit, round(max(winner_pace) * 1.4, 6) AS pace_limit
    FROM paces GROUP BY 1
    """,
)
def chart_bounds(spark, sf_dir):
    bounds = analytics.chart_bounds(analytics.distance_and_pace(cleaned(spark, sf_dir)))
    return bounds.withColumns({c: F.round(c, 6) for c in ("distance_limit", "pace_limit")})


@query(
    "overlapping_periods",
    f"""{_COVERAGE}
    SELECT series, first_edition, latest_edition, period_label FROM coverage
    JOIN (VALUES (1914.5, 1918.5, 'WWI'), (1939.5, 1946.5, 'WWII')) AS p(period_start, period_end, period_label)
      ON period_start < latest_edition AND period_end > first_edition
    """,
)
def overlapping_periods(spark, sf_dir):
    bounds = _coverage(spark, sf_dir).select("series", "first_edition", "latest_edition")
    return analytics.overlapping_periods(bounds).drop("period_start", "period_end")


_MARGINS = f"""
WITH {views.RESULTS},
margins AS (
  SELECT series, edition, CAST(min(gap_seconds) AS BIGINT) AS margin_seconds, min(gap_seconds) / 60.0 AS margin_minutes
  FROM results WHERE result_type = 'time' AND rank_number = 2 AND gap_seconds > 0 GROUP BY 1, 2
),
bounds AS (SELECT series, min(margin_minutes) AS low, max(margin_minutes) AS high FROM margins GROUP BY 1)
"""


def _margins(spark, sf_dir):
    return analytics.winning_margin(cleaned(spark, sf_dir))


@query(
    "filter_runner_up",
    f"""
    WITH {views.RESULTS}
    SELECT series, edition, row_no, participant, CAST(gap_seconds AS BIGINT) AS gap_seconds FROM results
    WHERE result_type = 'time' AND rank_number = 2 AND gap_seconds > 0
    """,
)
def filter_runner_up(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    return rows.where(
        (F.col("result_type") == "time") & (to_number(F.col("rank_text")) == 2) & (F.col("gap_seconds") > 0)
    ).select("series", "edition", "row_no", "participant", "gap_seconds")


@query(
    "winning_margin",
    f"{_MARGINS} SELECT series, edition, margin_seconds, round(CAST(margin_minutes AS DOUBLE), 6) AS margin_minutes FROM margins",
)
def winning_margin(spark, sf_dir):
    return _margins(spark, sf_dir).withColumn("margin_minutes", F.round("margin_minutes", 6))


@query(
    "margin_labels",
    f"""{_MARGINS}
    SELECT series, edition, margin_seconds,
      CASE WHEN margin_seconds < 120 THEN margin_seconds || ' seconds' ELSE margin_seconds // 60 || ' minutes' END AS margin_text,
      CASE WHEN margin_seconds < 60 THEN margin_seconds || '''''' ELSE printf('%d''%02d''''', margin_seconds // 60, margin_seconds % 60) END AS margin_short,
      count(*) OVER (PARTITION BY series) <= 10 AS labelled
    FROM margins
    """,
)
def margin_labels(spark, sf_dir):
    return analytics.margin_labels(_margins(spark, sf_dir)).drop("margin_minutes")


@query(
    "closest_edition",
    f"""{_MARGINS},
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY margin_seconds, edition) AS n,
             max(edition) OVER (PARTITION BY series) - min(edition) OVER (PARTITION BY series) AS span FROM margins)
    SELECT series, edition, margin_seconds, edition || ': ' ||
      CASE WHEN margin_seconds < 120 THEN margin_seconds || ' seconds' ELSE margin_seconds // 60 || ' minutes' END AS call_out
    FROM ranked WHERE n = 1 AND span >= 4
    """,
)
def closest_edition(spark, sf_dir):
    """The call-out, here from a span of four years on."""
    return analytics.closest_edition(_margins(spark, sf_dir), span=4)


@query(
    "margin_limits",
    f"""{_MARGINS}
    SELECT series, CAST(min(edition) - 2 AS INTEGER) AS axis_start, CAST(max(edition) + 2 AS INTEGER) AS axis_end,
           round(CASE WHEN count(*) <= 10 THEN min(CAST(margin_minutes AS DOUBLE)) * 0.4 END, 6) AS margin_floor,
           round(CASE WHEN count(*) <= 10 THEN max(CAST(margin_minutes AS DOUBLE)) * 3 END, 6) AS margin_ceiling
    FROM margins GROUP BY series
    """,
)
def margin_limits(spark, sf_dir):
    """Axis limits of the margin chart, with margin limits for sparse series."""
    limits = analytics.margin_limits(analytics.margin_bounds(_margins(spark, sf_dir)))
    return limits.select(
        "series", "axis_start", "axis_end", *[F.round(c, 6).alias(c) for c in ("margin_floor", "margin_ceiling")]
    )


@query(
    "scale_ticks",
    f"""{_MARGINS}
    SELECT series, tick_label, round(tick_value, 6) AS tick_value FROM bounds
    JOIN (VALUES (10 / 60::DOUBLE, '10 s'), (1, '1 min'), (10, '10 min'), (60, '1 h'), (600, '10 h'), (3000, '50 h')) AS t(tick_value, tick_label)
      ON tick_value BETWEEN low * 0.5 AND high * 2
    """,
)
def scale_ticks(spark, sf_dir):
    ticks = analytics.scale_ticks(analytics.margin_bounds(_margins(spark, sf_dir)))
    return ticks.select("series", "tick_label", F.round("tick_value", 6).alias("tick_value"))
