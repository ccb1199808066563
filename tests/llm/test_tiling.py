"""Greedy string tiling against a plain version over word lists."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from legwise.llm import string_tiling


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain_coverage(item, document, least):
    """Covered words: mark the longest common unmarked run, again and again."""
    marked_i, marked_d, covered = [False] * len(item), [False] * len(document), 0
    least = min(least, len(item))
    while item:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n]
                    and not marked_i[i + n] and not marked_d[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            break
        marked_i[i : i + n] = marked_d[j : j + n] = [True] * n
        covered += n
    return covered


def pairs_of(df):
    return {(r.doc_id, r.item_id): r.covered_words for r in df.collect()}


@pytest.mark.parametrize("block_bytes", [1 << 22, 60])
def test_against_the_plain_version(spark, block_bytes):
    draw = random.Random(3)
    some = lambda n: " ".join(draw.choice("abcdefgh") + draw.choice("xyz") for _ in range(n))
    items = [(i, some(draw.randint(0, 30))) for i in range(12)]
    docs = []
    for d in range(40):
        parts = [some(draw.randint(0, 15))]
        for _ in range(draw.randint(0, 2)):
            source = words(draw.choice(items)[1])
            cut = draw.randint(0, len(source))
            parts += [" ".join(source[cut:]).upper(), some(2), ", ".join(source[:cut])]
        docs.append((d, "\n".join(parts)))
    found = string_tiling.contaminated(
        spark.createDataFrame(docs, "doc_id int, text string").repartition(3),
        spark.createDataFrame(items, "item_id int, text string"), threshold=0.5, min_match=4, block_bytes=block_bytes,
    )
    expected = {}
    for d, text in docs:
        for i, item in items:
            covered = plain_coverage(words(item), words(text), 4)
            if words(item) and covered >= 0.5 * len(words(item)):
                expected[d, i] = covered
    assert pairs_of(found) == expected and len(expected) > 10


def test_reordered_sentences_and_odd_rows(spark):
    item = "One two three four five six. Seven eight nine ten eleven twelve. Thirteen fourteen fifteen sixteen seventeen."
    moved = "Intro. Thirteen fourteen fifteen sixteen seventeen, SEVEN eight nine ten eleven twelve! And one two three four five six."
    clean = "One two three four. Seven eight nine ten. " * 5
    docs = [(1, moved, 1), (2, clean, 2), (3, None, 3), (4, "", 4), (5, item * 50, 5), (5, item * 50, 5), (None, "x " * 9000 + item, 6), (8, "Ünï", 7)]
    items = [(10, item), (10, item), (11, None), (12, ""), (13, "ünï"), (None, "x x")]
    frame = spark.createDataFrame(docs, "doc_id int, text string, item_id int")
    found = string_tiling.contaminated(frame, spark.createDataFrame(items, "item_id int, text string"))
    got = sorted((repr(r.doc_id), repr(r.item_id), r.coverage) for r in found.collect())
    rows = [("1", "10"), ("1", "10"), *[("5", "10")] * 4, ("8", "13"), ("None", "10"), ("None", "10"), ("None", "None")]
    assert got == [(d, i, 1.0) for d, i in rows]
    spans = found.where("doc_id = 1").first().tiles
    assert sorted(s.item_word for s in spans) == [0, 6, 12]
    assert string_tiling.contaminated(frame.limit(0), spark.createDataFrame(items, "item_id int, text string")).count() == 0
    assert string_tiling.contaminated(frame, spark.createDataFrame([], "item_id int, text string")).count() == 0


def test_a_common_phrase_is_not_multiplied_out():
    """An item is tiled only if its windows that the document has can reach the threshold."""
    draw = random.Random(5)
    phrase = "this phrase is in every one of the items"
    some = lambda n: " ".join(draw.choice("abcdefgh") + draw.choice("uvwxyz") for _ in range(n))
    texts = [f"{some(20)} {phrase} {some(20)}" for _ in range(300)]
    table = string_tiling.Items(texts, 5)
    document = f"{phrase}. " * 300 + texts[7].upper() + "\nmore " + texts[9]
    (block,) = string_tiling.blocks(pa.array([None, document.lower(), phrase, ""]))
    found = list(table.seeds(string_tiling._words(block), 0.6))
    assert len(found) == 1 and found[0][1] == 1 and set(found[0][3].tolist()) == {7, 9}
    assert len(found[0][2]) < 2 * (302 * 9 + 100)  # two items' windows, not 300
    every = sum(len(set(which.tolist())) for _, _, _, which, _ in table.seeds(string_tiling._words(block), 0.1))
    assert every == 2 * 300
    got = sorted(row[:4] for row in string_tiling._covering(pa.array([None, document.lower(), phrase, ""]), table, 0.6))
    assert got == [(1, 7, 49, 49), (1, 9, 49, 49)]
    assert np.all(string_tiling._ranges(np.array([4, 9]), np.array([2, 3])) == [4, 5, 9, 10, 11])
