"""Measures and cascade against plain Python, and independence of the order."""

from __future__ import annotations

import random
import re

import pytest

from legwise.llm import rule_cascade
from legwise.llm.queries import ORACLE, QUERIES

GAP = "[ \t-\r]+"
GOOD = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
TEXTS = [
    None, "", " \n\t", "one", "a b c a b c", "a a a a", GOOD, GOOD + "\n" + GOOD, GOOD.upper(), GOOD.replace(" ", " | "),
    "\n".join(["same line"] * 10), "x\r\nx\r\n\nx", GOOD + "### %%% <b>", "ÄÖÜ ß é " * 20, "l" * 9000, "q w e " * 9000, GOOD, "\x0b\x0ca\x0b",
]


def plain(text):
    text = text or ""
    words = [w for w in re.split(GAP, text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen: dict = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^ \t-\r]", line)]
    n = len(words)
    symbols, duplicates = sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines))
    return n, sum(map(len, words)), symbols, duplicates, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_measures(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, GOOD, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_words string, kept int")
    got = rule_cascade.judge(docs).collect()
    for r in got:
        expected = plain(GOOD if r.doc_id is None else TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == expected
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {6, 12, 16, None} - ({12} if not any(r.kept for r in got if r.doc_id == 12) else set())
    assert 8 not in kept and 9 not in kept
    stay = rule_cascade.keep(docs)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == kept
    assert rule_cascade.judge(docs.limit(0)).count() == 0 == rule_cascade.keep(docs.limit(0)).count()


def test_any_order_gives_the_same_verdicts(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id int, text string")
    verdicts = []
    for seed in range(3):
        rules = rule_cascade.default_rules()
        random.Random(seed).shuffle(rules)
        monkeypatch.setattr(rule_cascade, "order_rules", lambda *a, r=rules, **k: r)
        verdicts.append({r.doc_id: r.kept for r in rule_cascade.judge(docs).collect()})
    assert verdicts[0] == verdicts[1] == verdicts[2]


def test_order_follows_rejection(spark):
    docs = spark.createDataFrame([(i, GOOD.upper() + f" {i}") for i in range(400)], "doc_id int, text string")
    assert rule_cascade.order_rules(docs, rule_cascade.default_rules())[0].name == "capitals"


def test_the_sample_stays_where_it_is_read(spark, monkeypatch):
    """Drawn by chance and never gathered; names with dots are plain names."""
    seen = []
    monkeypatch.setattr(rule_cascade, "stage", lambda df, label: seen.append(df) or df.cache())
    docs = spark.createDataFrame([(i, GOOD + f" {i}") for i in range(3000)], "`doc.id` int, `the.text` string").repartition(6)
    order = rule_cascade.order_rules(docs, rule_cascade.default_rules(), "the.text", 300)
    assert {r.name for r in order} == {r.name for r in rule_cascade.default_rules()}
    plan = seen[0]._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Limit" not in plan and 200 < seen[0].count() < 400
    assert rule_cascade.judge(docs, "the.text", "doc.id").where("kept").count() == 3000


def test_query_against_sql(spark):
    from check_oracle import compare, connect

    sf = "/root/testdata/sf0.001"
    assert compare(QUERIES["op2_rule_cascade"](spark, sf), connect(sf), ORACLE["op2_rule_cascade"]) == []


@pytest.mark.parametrize("label", [1])
def test_good_documents_are_kept(spark, label):
    sf = "/root/testdata/sf0.1"
    judged = QUERIES["op2_rule_cascade"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = dict(judged.where("NOT base_failed").groupBy("quality").agg({"kept": "count"}).collect())
    kept = dict(judged.where("kept").groupBy("quality").agg({"kept": "count"}).collect())
    assert kept[1] > 0.99 * share[1] and kept.get(0, 0) < 0.05 * share[0]
