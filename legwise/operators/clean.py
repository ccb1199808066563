"""Cleaning results: seconds, result types, edition constants, rebased totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions.durations import duration_seconds, plausible_gap
from legwise.functions.text import title_case
from legwise.operators.joins import attach
from legwise.operators.ordering import first_value_per_group
from legwise.schema import (
    DISTANCE_OVERRIDES,
    EDITION,
    EDITION_KEY,
    NO_RESULT_EDITIONS,
    POINTS_EDITIONS,
    REBASED_EDITIONS,
    SERIES,
)

# How an edition was decided.
BY_TIME, BY_POINTS, NO_RESULTS = "time", "points", "no-results"


def result_type(edition: Column) -> Column:
    """How the edition was decided: on time, on points, or without usable values."""
    return (
        F.when(edition.isin(*NO_RESULT_EDITIONS), NO_RESULTS)
        .when(edition.isin(*POINTS_EDITIONS), BY_POINTS)
        .otherwise(BY_TIME)
    )


def apply_overrides(
    df: DataFrame,
    value: str,
    overrides: DataFrame,
    keys: Sequence[str] = EDITION_KEY,
    override: str = "override",
) -> DataFrame:
    """Replace ``value`` where it is 0 and an override exists for the keys.

    ``overrides`` is a list of literal rows or a stored table, so Spark knows its size.
    """
    joined = attach(df, overrides.select(*keys, F.col(override).alias("_override")), keys, written=True)
    replaced = F.when((F.col(value) == 0) & F.col("_override").isNotNull(), F.col("_override"))
    return joined.withColumn(value, replaced.otherwise(F.col(value))).drop("_override")


def distance_overrides(df: DataFrame) -> DataFrame:
    """The fixed distance overrides as a table of literal rows, whose size Spark knows before it runs."""
    rows = [
        F.struct(F.lit(series).alias(SERIES), F.lit(edition).alias(EDITION), F.lit(km).alias("override"))
        for series, edition, km in DISTANCE_OVERRIDES
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def zero_unless_timed(df: DataFrame, columns: Sequence[str], type_column: str = "result_type") -> DataFrame:
    """Derived seconds are 0 for editions not decided on time; the printed text stays."""
    timed = F.col(type_column) == BY_TIME
    return df.withColumns(
        {c: F.when(timed, F.col(c)).otherwise(F.lit(0).cast("bigint")) for c in columns}
    )


def with_seconds(df: DataFrame, times: str = "times", gap: str = "gap") -> DataFrame:
    """Add total_seconds and gap_seconds; an absent text column counts as 0."""
    zero = F.lit(0).cast("bigint")
    total = duration_seconds(F.col(times)) if times in df.columns else zero
    behind = duration_seconds(F.col(gap)) if gap in df.columns else zero
    # a step of its own, so that the parsed gap is not computed again for the comparison
    parsed = df.withColumns({"total_seconds": total, "gap_seconds": behind})
    return parsed.withColumn("gap_seconds", plausible_gap(F.col("gap_seconds")))


def leg_counts(legs: DataFrame, keys: Sequence[str] = EDITION_KEY) -> DataFrame:
    return legs.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("leg_count"))


def with_leg_counts(df: DataFrame, legs: DataFrame, keys: Sequence[str] = EDITION_KEY) -> DataFrame:
    """Attach each edition's number of legs; 0 for an edition without legs."""
    joined = attach(df, leg_counts(legs, keys), keys)
    return joined.withColumn("leg_count", F.coalesce("leg_count", F.lit(0)))


def rebase_from_leader(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = EDITION_KEY,
    editions: Sequence[int] = REBASED_EDITIONS,
    edition: str = EDITION,
    total: str = "total_seconds",
    gap: str = "gap_seconds",
) -> DataFrame:
    """In the given editions, totals become the first row's total plus the own gap.

    The first row in source order keeps its total.  Its values come from one
    aggregation over those editions only, attached by size, so no edition is
    sorted in one task.
    """
    affected = df.where(F.col(edition).isin(*editions))
    first = first_value_per_group(affected, group, order, [total, *order])
    renamed = first.select(
        *group, F.col(total).alias("_base"), F.struct(*order).alias("_first_row")
    )
    joined = attach(df, renamed, group)
    is_first = F.struct(*order) == F.col("_first_row")
    rebased = F.when(
        F.col("_base").isNotNull() & ~is_first, F.col("_base") + F.col(gap)
    ).otherwise(F.col(total))
    return joined.withColumn(total, rebased).drop("_base", "_first_row")


def timed_results(
    df: DataFrame, order: Sequence[str] = ("row_no",), rebase_group: Sequence[str] = EDITION_KEY
) -> DataFrame:
    """Result types and seconds for the results of all editions at once."""
    typed = with_seconds(df).withColumn("result_type", result_type(F.col(EDITION)))
    zeroed = zero_unless_timed(typed, ["total_seconds", "gap_seconds"])
    return rebase_from_leader(zeroed, order, rebase_group)


def clean_results(
    df: DataFrame,
    legs: DataFrame,
    order: Sequence[str] = ("row_no",),
    rebase_group: Sequence[str] = EDITION_KEY,
) -> DataFrame:
    """Result types, seconds and leg counts for the results of all editions at once."""
    return with_leg_counts(timed_results(df, order, rebase_group), legs)


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Without the columns that hold no value at all (one counting pass)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    kept = [c for i, c in enumerate(df.columns) if counts[str(i)] > 0 or c in keep]
    return df.select(*[F.col(f"`{c}`") for c in kept])


def title_case_columns(df: DataFrame, words: Sequence[str] = ("winner", "jersey")) -> DataFrame:
    """Title-case every text column, and every entry of a column of named texts, whose name contains one of the words."""

    def named(name: Column) -> Column:
        found = F.lit(False)
        for word in words:
            found |= F.contains(F.lower(name), F.lit(word))
        return found

    maps = [name for name, kind in df.dtypes if kind == "map<string,string>"]
    chosen = [c for c in df.columns if c not in maps and any(word in c.lower() for word in words)]
    texts = {c: title_case(F.col(f"`{c}`")) for c in chosen}
    entries = {c: F.transform_values(F.col(f"`{c}`"), lambda k, v: F.when(named(k), title_case(v)).otherwise(v)) for c in maps}
    return df.withColumns(texts | entries)


def pace(distance: Column, seconds: Column) -> Column:
    """Kilometres per hour, NULL without recorded time."""
    return F.when(seconds > 0, distance / (seconds / 3600))
