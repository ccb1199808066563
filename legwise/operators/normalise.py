"""Normalising exported tables: whole-number columns, leg numbers, numeric order."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions.numbers import leg_number_text, to_number, whole_number
from legwise.operators.ordering import number_rows
from legwise.schema import Role, Roles, having

logger = logging.getLogger(__name__)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _lossless(name: str) -> Column:
    """Whether every value present is a whole number that BIGINT holds; true for no rows."""
    keeps = _col(name).isNull() | whole_number(_col(name)).isNotNull()
    return F.coalesce(F.every(keeps), F.lit(True))


def lossless_int_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: may it become an integer column without loss?  One pass for all."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column_name string, lossless boolean")
    verdicts = df.agg(*[_lossless(c).alias(f"v{i}") for i, c in enumerate(present)])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("lossless")) for i, c in enumerate(present)]
    )
    return verdicts.select(F.inline(pairs))


def to_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the lossless columns to BIGINT and leave the others as they are."""
    verdict = {row.column_name: row.lossless for row in lossless_int_check(df, columns).collect()}
    for name in [c for c, lossless in verdict.items() if not lossless]:
        logger.warning("column %r holds values that are not whole numbers; left as is", name)
    return df.select(
        *[
            whole_number(_col(c)).alias(c) if verdict.get(c) else _col(c)
            for c in df.columns
        ]
    )


def numeric_keys(roles: Roles, available: Sequence[str]) -> list[Column]:
    """The key columns as numbers, nulls last; absent columns are skipped."""
    return [to_number(_col(c)).asc_nulls_last() for c in having(roles, Role.KEY) if c in available]


def apply_roles(df: DataFrame, roles: Roles) -> DataFrame:
    """Whole-number columns as integers and leg numbers as minimal text."""
    cast = to_integers(df, [c for c in having(roles, Role.WHOLE) if c in df.columns])
    formatted = {c: leg_number_text(_col(c)) for c in having(roles, Role.LEG) if c in df.columns}
    return cast.withColumns(formatted) if formatted else cast


def ordered(df: DataFrame, roles: Roles, ties: Sequence[str]) -> DataFrame:
    """Rows in numeric key order; ``ties`` (the source order) settles equal keys."""
    return df.orderBy(*numeric_keys(roles, df.columns), *[_col(c).asc_nulls_last() for c in ties])


def numeric_positions(
    df: DataFrame, roles: Roles, ties: Sequence[str], number: str = "position"
) -> DataFrame:
    """Each row's 1-based position in numeric key order, without one task holding all rows."""
    keys = [c for c in having(roles, Role.KEY) if c in df.columns]
    keyed = df.withColumns({f"_key_{i}": to_number(_col(c)) for i, c in enumerate(keys)})
    names = [f"_key_{i}" for i in range(len(keys))]
    return number_rows(keyed, [], [*names, *ties], number).drop(*names)
