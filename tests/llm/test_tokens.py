"""Token counts and packing against the tokenizer library itself."""

from __future__ import annotations

import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from legwise.llm import piece_counts, pretokens, tier_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "The cat's  hat\n\n\n on 12 mats — ¿qué?  ",
    "", None, "   ", "\t\n", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>", "<|endoftext", "x" * 5000,
    "the " * 70_000, "日本語 テキスト ½ ² १२ é́", "don't 'll 's  's", "same", "same", "word word　x\u0085y \x1c z",
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(pretokens.encoder(pretokens.definition(PATH)).ids(text), "<u4").tolist()


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(text):
    assert ours(text) == library_ids(text)


def test_ids_around_every_character_class():
    some = [chr(c) for c in range(0x2100) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}b {c}c  {c}\n" for c in some)
    assert ours(text) == library_ids(text)


def test_long_runs_take_the_librarys_own_way():
    for text in ("ab" * 150_000, " " * 200_000, "x " * 9000 + "y" * 5000 + "\n" * 5000 + "<|endoftext|>z"):
        assert ours(text) == library_ids(text)


def test_long_texts_are_split_in_safe_places(monkeypatch):
    monkeypatch.setattr(pretokens, "SEGMENT", 50)
    text = "It's a  long text, with\n\n lines and 'quotes' " * 40 + "y" * 400
    code = pretokens.encoder(pretokens.definition(PATH))
    assert sum((ids for part in code.pretokens(text) for ids in code.encode(part)), []) == library_ids(text)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "null key", "x", 2), (3, "repeated id", "y", 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, row string, tokens int").repartition(3)


def test_counts(spark, docs):
    got = sorted(map(repr, (tuple(r) for r in piece_counts.count_tokens(docs, PATH).collect())))
    expected = []
    for row in docs.collect():
        n = len(library_ids(row.text))
        expected.append(repr((row.doc_id, len((row.text or "").encode()), n, n > 512)))
    assert got == sorted(expected)
    assert piece_counts.count_tokens(docs.limit(0), PATH).count() == 0


def check_packing(rows, texts):
    """Every id in one piece, windows gapless, and their padding."""
    for key, text in texts.items():
        ids = np.array([*library_ids(text), 1], "<u4")
        mine = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert sum(r.length for r in mine) == len(ids) == mine[0].doc_tokens
        assert all(bytes(r.ids) == ids[r.start : r.start + r.length].tobytes() for r in mine)
    windows: dict = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for pieces in windows.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        total = sum(p.length for p in pieces)
        assert total <= 2048 and len({p.tier for p in pieces}) == len({p.step_group for p in pieces}) == 1
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    return padding, windows


def test_packing(spark, docs):
    unique = docs.where("doc_id IS NOT NULL AND text != 'repeated id' OR text IS NULL").coalesce(1)
    rows = tier_packing.pack(unique, PATH).collect()
    padding, windows = check_packing(rows, {i: t for i, t in enumerate(TEXTS)})
    assert padding < 2048
    steps: dict = {}
    for pieces in windows.values():
        steps.setdefault(pieces[0].step_group, []).append(pieces[0].tier)
    assert all(sum(tiers) <= tier_packing.STEP_TOKENS for tiers in steps.values())
    assert tier_packing.pack(docs.limit(0), PATH).count() == 0
    assert tier_packing.pack(docs, PATH).where("doc_id IS NULL").agg(F.sum("length")).first()[0] == len(library_ids("null key")) + 1


def test_packing_in_small_parts(spark, monkeypatch):
    texts = {i: "word and more " * (37 * i % 900) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string").coalesce(1)
    rows = tier_packing.pack(df, PATH).collect()
    padding, windows = check_packing(rows, texts)
    assert padding < 2048 and {p[0].tier for p in windows.values()} >= {512, 2048}


def test_crc_of_ids(spark):
    row = tier_packing.pack(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), PATH).withColumn("c", F.crc32("ids")).first()
    assert row.c == zlib.crc32(np.array([*library_ids("a b"), 1], "<u4").tobytes())


if __name__ == "__main__":
    sys.exit(pytest.main([__file__]))
