"""Durations: parsing the printed forms and printing seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from legwise.functions.numbers import SPACES, div
from legwise.schema import GAP_LIMIT_SECONDS

_CLOCK = (
    r"^\s*(?:\d{4}-\d{2}-\d{2}[T ])?(\d{1,2}):([0-5]\d)(?::([0-5]\d)(?:\.\d+)?)?\s*([AaPp][Mm])?\s*$"
)


def _spoken_seconds(text: Column) -> Column:
    """Seconds of ``76h 00' 32''``; NULL if one of the first three parts is unreadable.

    The appended parts stand for those left out.  Odd white space becomes a blank,
    which the cast ignores at the ends of a number and rejects inside it.
    """
    odd = SPACES.replace(" ", "")
    marks = F.translate(text, "h'\"-" + odd + " +", ":::0" + " " * len(odd))
    parts = F.split(F.concat(marks, F.lit(":0:0")), ":")
    hours, minutes, seconds = (F.get(parts, F.lit(i)).try_cast("bigint") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds


def _clock_seconds(text: Column) -> Column:
    """Seconds of a clock time, optionally after a date; NULL for other text."""
    hour = F.regexp_extract(text, _CLOCK, 1).try_cast("bigint")
    half = F.lower(F.regexp_extract(text, _CLOCK, 4))
    hour24 = (
        F.when((half == "") & (hour < 24), hour)
        .when((half == "am") & hour.between(1, 12), hour % 12)
        .when((half == "pm") & hour.between(1, 12), hour % 12 + 12)
    )
    minutes = F.regexp_extract(text, _CLOCK, 2).try_cast("bigint") * 60
    seconds = F.coalesce(F.regexp_extract(text, _CLOCK, 3).try_cast("bigint"), F.lit(0))
    return F.when(F.contains(text, F.lit(":")), hour24 * 3600 + minutes + seconds)


def duration_seconds(text: Column) -> Column:
    """Seconds of ``76h 00' 32''``-like text or of a clock time; otherwise 0.

    Hours, minutes and seconds are the first three parts, a part left out adds
    nothing, later parts are ignored, and one unreadable part makes it 0.
    """
    # a product, not a branch: the split text is then computed once for all parts
    has_hours = F.when(F.contains(text, F.lit("h")), 1)
    return F.coalesce(_spoken_seconds(text) * has_hours, _clock_seconds(text), F.lit(0).cast("bigint"))


def plausible_gap(seconds: Column, limit: int = GAP_LIMIT_SECONDS) -> Column:
    """0 for gaps above ``limit`` seconds."""
    return F.when(seconds > limit, F.lit(0).cast("bigint")).otherwise(seconds)


def duration_text(seconds: Column) -> Column:
    """``HHh MM' SS''``."""
    return F.format_string(
        "%02dh %02d' %02d''", div(seconds, 3600), div(seconds % 3600, 60), seconds % 60
    )


def gap_text(seconds: Column) -> Column:
    """``-`` for the leader, ``+ HHh MM' SS''`` behind."""
    return F.when(seconds == 0, "-").otherwise(F.concat(F.lit("+ "), duration_text(seconds)))


def margin_text(seconds: Column) -> Column:
    """Seconds below two minutes, whole minutes from there on."""
    return F.when(seconds < 120, F.concat(seconds.cast("string"), F.lit(" seconds"))).otherwise(
        F.concat(div(seconds, 60).cast("string"), F.lit(" minutes"))
    )


def margin_text_short(seconds: Column) -> Column:
    """``8''`` or ``3'48''``."""
    return F.when(div(seconds, 60) == 0, F.format_string("%d''", seconds)).otherwise(
        F.format_string("%d'%02d''", div(seconds, 60), seconds % 60)
    )
