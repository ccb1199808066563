"""Number parsing and formatting as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
_WHOLE = r"^[+-]?\d+(\.0*)?$"
_NUMBER_START = r"^[+-]?\.?\d"

# Every character that counts as white space at the edges of a text.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_text(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.trim(text, F.lit(SPACES))


def to_number(value: Column) -> Column:
    """DOUBLE when the whole text is a number, otherwise NULL.

    The pattern is checked first because a bare cast also takes ``3d``,
    ``Infinity`` and ``NaN``.
    """
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def is_whole(number: Column) -> Column:
    return number == F.rint(number)


def whole_number(value: Column) -> Column:
    """BIGINT of a whole number however it is written, every digit kept; otherwise NULL.

    Only exponent forms go through DOUBLE, and only as far as it is exact.
    """
    text = F.trim(value.cast("string"))
    digits = F.substring_index(text, ".", 1).try_cast("decimal(38,0)").try_cast("bigint")
    number = to_number(text)
    exact = is_whole(number) & (F.abs(number) <= 2**53)
    return F.when(text.rlike(_WHOLE), digits).otherwise(F.when(exact, number.cast("bigint")))


def div(a: Column, b: int) -> Column:
    """Integer division."""
    return F.call_function("div", a, F.lit(b))


def leg_number_text(value: Column) -> Column:
    """``13.0`` -> ``13``, ``13.1`` -> ``13.1``; anything not a number -> NULL."""
    number = to_number(value)
    return F.when(is_whole(number), number.try_cast("bigint").cast("string")).otherwise(
        number.cast("string")
    )


def canonical(value: Column) -> Column:
    """One text per value: ``11.0`` and ``11`` agree, blanks trimmed, missing is ''.

    Text that does not begin like a number is settled by the first test.  Whole
    numbers go through DECIMAL(38,0), so long identifiers keep all digits and
    ``1.0E7``, as a DOUBLE is written, agrees with ``10000000``.
    """
    trimmed = strip_text(value.cast("string"))
    word = F.when(F.lower(trimmed) == "nan", "").otherwise(trimmed)
    number = trimmed.try_cast("double")
    whole = F.substring_index(trimmed, ".", 1).try_cast("decimal(38,0)").cast("string")
    return F.coalesce(
        F.when(~trimmed.rlike(_NUMBER_START), word),
        F.when(trimmed.rlike(_WHOLE), whole),
        F.when(trimmed.rlike(_NUMBER) & is_whole(number), number.try_cast("decimal(38,0)").cast("string")),
        F.when(trimmed.rlike(_NUMBER), number.cast("string")),
        trimmed,
        F.lit(""),
    )


def round_half_even(value: Column) -> Column:
    """Nearest whole number, halves to the even neighbour."""
    return F.bround(value).cast("bigint")
