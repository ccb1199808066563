"""Fill-in-the-middle: a text cut into prefix, middle and suffix and put in another order.

A text is a row of units (code points, or whatever ``unit`` matches).  ``regexp_count``
gives their number n; two draws of 0 to n from a hash of the id are the cuts.  The
pattern of a row is made of them: one group of ``unit{a}+``, one of ``unit{b - a}+`` and
the rest, all possessive, so a single match walks the text once, never steps back, and
its groups are prefix, middle and suffix.  The replacement of the same match is the output.

Forms: ``psm`` is P prefix S suffix M middle, ``spm`` is S suffix P prefix M middle, and
``plain`` is the text itself: of ``plain_percent`` of the rows, of empty texts, and of texts
that contain a marker, since these could not be told apart again.

All of it is column expressions without a shuffle.  Units are counted in runs of
``RUN`` first, because ``regexp_count`` builds a list of its matches.

Defined results: a null text is empty, a null id is drawn as an empty one; every input row
gives one output row, equal ids are cut alike; other input columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE_POINT = "."
RUN = 512


class Markers(NamedTuple):
    """Texts before the prefix, the suffix and the middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def check(self) -> Markers:
        """Markers can be found again in an output if none can begin inside another or inside a marker's beginning."""
        first = self.prefix[:1]
        if not first or any(m[:1] != first or first in m[1:] for m in self) or any(a != b and b.startswith(a) for a in self for b in self):
            raise ValueError("markers must begin with one character that none of them repeats, and none may begin with another")
        if len(set(self)) < 3:
            raise ValueError("markers must differ")
        return self


def n_units(text: Column, unit: str = CODE_POINT) -> Column:
    """How many units ``unit`` matches from the left."""
    run = f"(?s)(?:{unit}){{{RUN}}}+"
    rest = F.regexp_replace(text, rf"(?s)\A(?:(?:{unit}){{{RUN}}}+)++", "")
    return (F.regexp_count(text, F.lit(run)) * RUN + F.regexp_count(rest, F.lit(f"(?s){unit}"))).cast("bigint")


def draws(key: Column, salt: str) -> list[Column]:
    """Eight unsigned 32-bit numbers from the sha256 of the salt and the id."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(8)]


def _literal(marker: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", marker)


def _quoted(marker: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", marker)


def arranged(text: Column, form: Column, a: Column, b: Column, markers: Markers, unit: str = CODE_POINT) -> Column:
    """The output of ``form``: one match of the row's own pattern, replaced by its groups."""
    p, s, m = (_literal(x) for x in markers)
    pattern = F.concat(
        F.lit(rf"(?s)\A((?:{unit}){{"), a.cast("string"), F.lit(rf"}}+)((?:{unit}){{"), (b - a).cast("string"), F.lit(r"}+)(.*+)\z")
    )
    order = F.when(form == "spm", F.lit(f"{s}$3{p}$1{m}$2")).otherwise(F.lit(f"{p}$1{s}$3{m}$2"))
    return F.when(form == "plain", text).otherwise(F.regexp_replace(text, pattern, order))


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that ``output`` was made of."""
    p, s, m = (_quoted(x) for x in markers.check())
    spm = form == "spm"
    pattern = F.when(spm, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z")).otherwise(F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"))
    order = F.when(spm, F.lit("$2$3$1")).otherwise(F.lit("$1$3$2"))
    return F.when(form == "plain", output).otherwise(F.regexp_replace(output, pattern, order))


def transform(
    docs: DataFrame, text: str = "text", key: str = "doc_id", salt: str = "1:", plain_percent: int = 10, spm_percent: int = 20,
    markers: Markers = Markers(), unit: str = CODE_POINT,
) -> DataFrame:
    """``key``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output`` of every row.

    ``unit`` is a pattern without groups that matches one character at least wherever a text goes on.
    """
    markers.check()
    found = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    first, second, kind, order = draws(F.col("key"), salt)[:4]
    found = found.withColumn("n", n_units(F.col("text"), unit))
    marked = F.lit(False)
    for marker in markers:
        marked |= F.contains("text", F.lit(marker))
    plain = (F.col("n") == 0) | marked | (kind % 100 >= 100 - plain_percent)
    found = found.select(
        "key", "text", "n", (first % (F.col("n") + 1)).alias("one"), (second % (F.col("n") + 1)).alias("other"),
        F.when(plain, "plain").when(order % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
    )
    a, b = F.least("one", "other"), F.greatest("one", "other")
    cut = F.col("form") != "plain"
    return found.select(
        F.col("key").alias(key), "n", "form", F.when(cut, a).alias("prefix_chars"), F.when(cut, b - a).alias("middle_chars"),
        arranged(F.col("text"), F.col("form"), a, b, markers, unit).alias("output"),
    )
