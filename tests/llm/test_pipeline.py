"""The pipeline against a brute-force version on the smallest tables, and its odd tables."""

from __future__ import annotations

import pyarrow as pa
import pytest

import corpus_pipeline
from legwise.llm import neighbour_vote, rule_cascade
from legwise.llm.queries import remainder
from legwise.llm.registry import table
from legwise.llm.texts import blocks
from tests.llm.test_combination_join import plain_components, shingle_set
from tests.llm.test_tiling import plain_coverage, words

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = [r.asDict() for r in table(spark, SF, "documents").orderBy("doc_id").collect()]
    judged = {r.doc_id: r.kept for r in rule_cascade.judge(table(spark, SF, "documents")).collect()}
    docs = [d for d in docs if judged[d["doc_id"]]]
    space = neighbour_vote.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), remainder(5) != 0)
    scores = [s for b in blocks(pa.array([d["text"] for d in docs])) for s in neighbour_vote.vote(space, b)]
    docs = [d for d, s in zip(docs, scores) if s >= 0.3]
    groups = plain_components([shingle_set(d["text"]) for d in docs])
    docs = [d for i, d in enumerate(docs) if groups[i] == i]
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]
    seeds = {tuple(item[i : i + 5]) for item in items for i in range(len(item) - 4)}

    def leaks(text):
        mine = words(text)
        near = any(tuple(mine[i : i + 5]) in seeds for i in range(len(mine) - 4))
        return near and any(item and plain_coverage(item, mine, 5) >= 0.6 * len(item) for item in items)

    texts = {d["doc_id"]: d["text"] for d in docs if not leaks(d["text"])}
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    assert {r["doc_id"] for r in rows} == set(texts) and 50 < len(texts) < len(judged)
    lengths: dict = {}
    for r in rows:
        lengths.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for spans in lengths.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert spans[-1][0] + spans[-1][1] == spans[0][2]


def test_order_and_columns_of_the_stages(spark):
    docs = table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "decontamination", "packing"
    ]
    for _, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, SF).columns == docs.columns


@pytest.mark.parametrize("index", range(5))
def test_odd_tables(spark, tmp_path, index):
    name, apply = corpus_pipeline.STAGES[index]
    good = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)) + "."
    rows = [(None, good, None, None, None, 1), (1, good, "en", "s", 1, 2), (1, good, "en", "s", 1, 2), (2, None, "en", "s", 0, 3), (3, "", "en", "s", 0, 4)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "odd"))
    docs = spark.read.parquet(str(tmp_path / "odd"))
    kept = apply(spark, docs, SF)
    got = sorted(((r.doc_id is None, r.doc_id or 0) for r in kept.collect()))
    expected = {
        "quality_rules": [(False, 1)] * 2 + [(True, 0)],
        "quality_classifier": [(False, 1)] * 2 + [(False, 2), (False, 3), (True, 0)],
        "near_duplicates": [(False, 1), (False, 2), (False, 3)],
        "decontamination": [(False, 1)] * 2 + [(False, 2), (False, 3), (True, 0)],
        "packing": [(False, 1)] * 2 + [(False, 2), (False, 3), (True, 0)],
    }
    assert got == expected[name]
    assert kept.columns == docs.columns or name == "packing"
    assert apply(spark, docs.limit(0), SF).count() == 0


