"""Generated text between marker comments in a table of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.functions.text import has_block, replace_block


def refresh_blocks(
    df: DataFrame, text: str, body: Column, marker: str, into: str = "updated_text"
) -> DataFrame:
    """Add ``has_marker``, the refreshed document, and whether it ``changed``.

    Documents without marks keep their text and are flagged by ``has_marker``.
    """
    document = F.col(text)
    updated = F.coalesce(replace_block(document, body, marker), document)
    return df.withColumns(
        {"has_marker": has_block(document, marker), into: updated, "changed": F.coalesce(updated != document, F.lit(False))}
    )


def stale_documents(df: DataFrame, text: str, body: Column, marker: str) -> DataFrame:
    """Documents whose marked block differs from ``body`` or that have no marks: the check mode."""
    refreshed = refresh_blocks(df, text, body, marker)
    return refreshed.where(F.col("changed") | ~F.col("has_marker"))


def require_markers(df: DataFrame, text: str, marker: str) -> None:
    """Raise when any document lacks the marks."""
    if not df.where(~has_block(F.col(text), marker)).isEmpty():
        raise ValueError(f"documents without the {marker!r} markers")
