"""Joins on the edition keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legwise.staging import stage


def left_join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a missing key matches a missing key.

    Null-safe equality stays a hash or sort-merge join, and AQE splits its skewed partitions.
    """
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, matched, "left").drop(*[f"_r_{k}" for k in keys])


def attach(
    df: DataFrame, constants: DataFrame, keys: Sequence[str], how: str = "left", written: bool = False
) -> DataFrame:
    """Add per-group constants to every row.

    The constants are written first, so Spark knows their size: below the broadcast
    threshold the rows are not shuffled, above it both sides are.  ``written`` says that
    their size is known as they are, as that of a stored table or of literal rows is.
    """
    return df.join(constants if written else stage(constants, "constants"), list(keys), how)


def without(df: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys_of`` (missing matches missing)."""
    listed = stage(keys_of.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct(), "keys")
    matched = F.lit(True)
    for k in keys:
        matched = matched & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(listed, matched, "left_anti")


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name, absent ones NULL."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def with_fallback(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The primary rows, and the fallback's rows for groups the primary lacks."""
    return union_by_name(primary, without(fallback, primary, keys))


def replace_groups(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with every group that occurs in ``new`` replaced by the new rows."""
    return union_by_name(without(old, new, keys), new)


def lookup(
    df: DataFrame, dimension: DataFrame, keys: Sequence[str], value: str, default: object
) -> DataFrame:
    """Add ``value`` by key, ``default`` where the key is unknown."""
    found = attach(df, dimension.select(*keys, value), keys)
    return found.withColumn(value, F.coalesce(value, F.lit(default)))
