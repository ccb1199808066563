"""The operators run on the driver's tables, each with its SQL counterpart."""

from spark_queries import assembly, cleaning, extraction, integrity, standings, summaries, tables, versions  # noqa: F401
from spark_queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
