"""Quality rules as a short-circuit cascade of SQL expressions.

Every text is measured with DataFrame functions only.  The rules behind the base
gate are tried in the order of rejected rows per second, both estimated on a
sample, and a row stops at the first rule it breaks.  The order changes the
cost, never the verdict.

Defined results: a null or empty text has no words and fails the base gate;
repeated rows are judged one by one; other columns of the input are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwise.staging import stage

GAP = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
#: Rows the order of the rules is estimated on, about.
SAMPLE_ROWS = 4000
#: Runs of a rule on the sample; the shortest counts.
RUNS = 3
#: Cost of a rule at least; shorter differences are not told from noise.
LEAST_SECONDS = 0.005


class Rule(NamedTuple):
    name: str
    broken: Column  # over the text and the measures


def _count(pattern: str) -> Column:
    return F.regexp_count("_text", F.lit(pattern))


def default_rules() -> list[Rule]:
    """Rules that clean prose in any language with spaces passes."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 5 * chars),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        Rule("word_length", (chars < 2 * n) | (chars > 15 * n)),
        Rule("capitals", 100 * _count(r"\p{Lu}") > 40 * chars),
        Rule("letters", 100 * _count(r"\p{L}") < 60 * chars),
        Rule("exclamations", 100 * _count("[!?]") > 10 * chars),
    ]


def _bound(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``value`` evaluated once as the lambda variable ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _repeated_words() -> str:
    """Words inside three-word windows that occur twice or more, from the array ``words``.

    Window hashes are sorted with their positions, equal neighbours mark the repeated
    windows, and the sorted positions of those give the words they cover.
    """
    windows = (
        "sort_array(slice(transform(words, (w, i) -> struct(xxhash64(w, get(words, i + 1), get(words, i + 2)) AS h,"
        " i AS i)), 1, greatest(size(words) - 2, 0)))"
    )
    places = (
        "sort_array(transform(filter(windows, (x, k) -> coalesce(get(windows, k - 1).h = x.h, false)"
        " OR coalesce(get(windows, k + 1).h = x.h, false)), x -> x.i))"
    )
    covered = (
        "aggregate(transform(places, (p, k) -> least(3, coalesce(get(places, k + 1) - p, 3))),"
        " 0L, (total, x) -> total + x)"
    )
    return _bound("windows", windows, _bound("places", places, covered))


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``_text`` and the measures of each row.

    ``_row`` is not deterministic to the optimizer: a filter that also reads it stays
    above the measures and does not evaluate them again.
    """
    words = "filter(split(_text, '[ \\t-\\r]+'), w -> w != '')"
    lines = "filter(split(_text, '\n'), l -> l rlike '[^ \\t-\\r]')"
    rows = docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    kept = F.col(f"`{key}`")
    rows = rows.select(
        kept,
        "_text",
        F.monotonically_increasing_id().alias("_row"),
        F.expr(_bound("words", words, f"struct(size(words) AS n, {_repeated_words()} AS repeated)")).alias("_words"),
        F.expr(_bound("lines", lines, "struct(size(lines) AS n, size(array_distinct(lines)) AS kinds)")).alias("_lines"),
    )
    return rows.select(
        kept,
        "_text",
        "_row",
        F.col("_words.n").cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("_text", F.lit(GAP), F.lit(""))).cast("bigint").alias("word_chars"),
        _count(SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.col("_lines.n") - F.col("_lines.kinds")).cast("bigint").alias("n_dup_lines"),
        F.col("_lines.n").cast("bigint").alias("n_lines"),
        F.col("_words.repeated").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


def order_rules(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejection per cost, estimated on a sample of about ``rows`` rows.

    Every row is drawn with the same chance where it is read, so no task gathers the sample.
    A rule's cost is the shortest of a few jobs that evaluate it on the written sample, less
    that of a job without a rule; its rejection is the share of the sample's gate-passing
    rows it rejects.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.lit(0).alias("row"))
    chance = min(1.0, rows / max(1, texts.select("row").count()))
    measured = measure(texts.sample(chance, seed=7) if chance < 1 else texts, key="row")
    sample = stage(measured.where((F.col("_row") >= 0) & ~base_failed()).drop("row"), "rule-sample")

    def run(broken: Column) -> tuple[float, int, int]:
        job, best = sample.agg(F.count(F.lit(1)), F.count_if(broken)), float("inf")
        for _ in range(RUNS):
            started = time.perf_counter()
            seen, rejected = job.first()
            best = min(best, time.perf_counter() - started)
        return best, seen, rejected

    empty, _, _ = run(F.length("_text") < 0)
    rates = []
    for rule in rules:
        took, seen, rejected = run(rule.broken)
        rates.append((rejected + 0.5) / (seen + 1) / max(took - empty, LEAST_SECONDS))
    return [rule for _, rule in sorted(zip(rates, rules), key=lambda pair: -pair[0])]


def first_broken(rules: Sequence[Rule]) -> Column:
    """True at the first broken rule; later rules are not evaluated."""
    verdict = F.when(base_failed(), True)
    for rule in rules:
        verdict = verdict.when(rule.broken, True)
    return verdict.otherwise(False)


def judge(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    rules: Sequence[Rule] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Measures and verdict of every row: ``key``, the measures, ``base_failed``, ``kept``."""
    ordered = order_rules(docs, default_rules() if rules is None else rules, text, sample_rows)
    return measure(docs, text, key).select(
        F.col(f"`{key}`"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~first_broken(ordered)).alias("kept"),
    )


def keep(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the gate and all rules, with their own columns."""
    ordered = order_rules(docs, default_rules(), text)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    measured = measure(docs.select(whole, F.col(f"`{text}`").alias("_body")), "_body", "_whole")
    return measured.where((F.col("_row") >= 0) & ~first_broken(ordered)).select("_whole.*")
