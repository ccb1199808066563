"""Fill-in-the-middle against plain slicing, odd rows, other units and markers, and exact restoring."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from legwise.llm import fill_in_middle as fim


def plain_version(doc_id, text):
    text, n = text or "", len(text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, kind, order = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or kind % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if order % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if order % 100 < 20 else "psm", a, b - a, out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(8)
    kinds = "abcé\n\r  \t$\\1{}<>PSM東😀𝔘é"
    texts = ["".join(draw.choice(kinds) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    texts += ["", None, "<P>", "a<S>b", "<M", "x<", "<P", "😀" * 1300, "ab" * 200_000, "z" * 512, "z" * 511, "z" * 1024, "\n" * 513, "$1\\2"]
    texts += ["x" * n for n in range(40)]
    return [(i, t, -1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, "with no id at all", 1), (-7, "negative id", 1)]


def test_against_slicing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(3)
    found = fim.transform(docs)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(((r[0], *plain_version(*r[:2])) for r in rows), key=repr)
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.again == texts[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(docs.limit(0)).count() == 0


def test_words_as_units_and_other_markers(spark):
    texts = ["one two  three\nfour ", "single", " lead", "a $b \\c $1", "w " * 2000]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, body string")
    marks = fim.Markers("\\[$a", "\\[$b", "\\[$c")
    found = fim.transform(docs, "body", "k", plain_percent=0, spm_percent=50, markers=marks, unit=r"(?:\S++\s*+|\s++)")
    got = {r.k: r for r in found.withColumn("again", fim.restored(F.col("output"), F.col("form"), marks)).collect()}
    assert [got[k].n for k in range(5)] == [4, 1, 2, 4, 2000]
    assert all(got[k].again == t for k, t in enumerate(texts))
    assert all(0 <= got[k].prefix_chars + got[k].middle_chars <= got[k].n for k in range(5))


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("<P>", "[S]", "<M>"), ("<P>", "<P>x", "<M>"), ("<P<", "<S>", "<M>"), ("", "<S>", "<M>")])
def test_markers_that_could_be_confused(spark, marks):
    with pytest.raises(ValueError, match="markers"):
        fim.transform(spark.createDataFrame([(1, "a")], "doc_id int, text string"), markers=fim.Markers(*marks))


def test_no_shuffle_and_no_python(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int").select("doc_id", "text")
    plan = fim.transform(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
