"""Text expressions: cleaning, casing, leg labels, links and marked blocks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from legwise.functions.numbers import strip_text, to_number

# A word is a run of letters that have case; everything else separates words.
_CASED_RUNS = r"([\p{IsUppercase}\p{IsLowercase}\p{Lt}]+|[^\p{IsUppercase}\p{IsLowercase}\p{Lt}]+)"


def cell_text(text: Column) -> Column:
    """A table cell as a table reader shows it: line breaks and wide gaps become one space."""
    return F.regexp_replace(strip_text(text), r"(?U)[\r\n]+|\s{2,}", " ")


def title_case(text: Column) -> Column:
    """Upper case after every character that is not a letter, lower case elsewhere.

    ``initcap`` alone only starts words after blanks.
    """
    return F.array_join(
        F.transform(F.regexp_extract_all(text, F.lit(_CASED_RUNS), F.lit(1)), F.initcap), ""
    )


def leg_number(label: Column) -> Column:
    """Leg number of ``Stage 13.1 : A > B``; a prologue is 0; unreadable is NULL."""
    token = F.get(F.split(F.get(F.split(label, ":"), F.lit(0)), " "), F.lit(1))
    whole = F.when(token.rlike(r"^\s*[+-]?\d+\s*$"), to_number(token))
    prologue = F.when(F.contains(label, F.lit("Prologue")), F.lit(0.0))
    return F.coalesce(whole, prologue, to_number(token))


def route_part(label: Column, position: int) -> Column:
    """Start (0) or end (1) of ``Stage 1 : A > B``; NULL when a separator is missing."""
    route = F.get(F.split(label, ":"), F.lit(1))
    return strip_text(F.get(F.split(route, ">"), F.lit(position)))


def first_number(text: Column, digits: str = r"\d{4}") -> Column:
    """First run of digits as INT, by default four long; NULL when there is none."""
    return F.nullif(F.regexp_extract(text, f"({digits})", 1), F.lit("")).try_cast("int")


def attribute_values(html: Column, attribute: str) -> Column:
    """All values of a double-quoted attribute, in document order."""
    return F.regexp_extract_all(html, F.lit(rf'{re.escape(attribute)}="([^"]+)"'), F.lit(1))


def _block_edges(marker: str) -> tuple[str, str]:
    return f"<!-- {marker}:start -->\n", f"\n<!-- {marker}:end -->"


def _block_span(text: Column, marker: str) -> tuple[Column, Column]:
    """1-based positions of the block's first character and of its end mark (0 if none)."""
    start, end = _block_edges(marker)
    opened = F.instr(text, F.lit(start))
    body = opened + len(start)
    closed = F.when(opened > 0, F.call_function("locate", F.lit(end), text, body)).otherwise(0)
    return body, closed


def has_block(text: Column, marker: str) -> Column:
    """Whether the document holds a start mark followed by an end mark."""
    return _block_span(text, marker)[1] > 0


def replace_block(text: Column, body: Column, marker: str) -> Column:
    """The document with its first marked block's text replaced; NULL without marks.

    The text is spliced, so backslashes and dollar signs in ``body`` stay literal.
    """
    begin, closed = _block_span(text, marker)
    before = F.substring(text, F.lit(1), begin - 1)
    after = F.substring(text, closed, F.length(text))
    return F.when(closed > 0, F.concat(before, body, after))
