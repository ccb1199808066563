"""Language by marginal unigrams: the lattice sums against listed segmentations, odd rows, held-out accuracy."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from legwise.llm import marginal_unigrams as unigrams
from legwise.llm.queries import QUERIES, RANKS

SF = "/root/testdata/sf0.1"
#: Piece list of the small lattices: all single letters that occur, and some longer pieces.
SMALL = b"\n".join(sorted([b" ", b"a", b"b", b"c", b" a", b"ab", b"abc", b"bc", b"ca", b" ab", b"aa", b"aaa", "é".encode(), b"\xc3", b"\xa9"]))


def segmentations(word: bytes, pieces: dict[bytes, int]):
    if not word:
        yield []
    for size in range(1, len(word) + 1):
        if word[:size] in pieces:
            for rest in segmentations(word[size:], pieces):
                yield [pieces[word[:size]], *rest]


def packed(words: list[bytes]) -> unigrams.Words:
    return unigrams.Words(np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *(len(w) for w in words)]))


@pytest.fixture
def small():
    pieces = {p: k for k, p in enumerate(SMALL.split(b"\n"))}
    shares = np.random.default_rng(4).random((len(pieces), 3))
    return pieces, unigrams.lattice(SMALL), shares / shares.sum(axis=0)


WORDS = [b" abc", b" a", b"abcabca", b"c", b" aaaaaa", " abéa".encode(), b" cab"]


def test_forward_sums_all_segmentations(small):
    pieces, trie, shares = small
    got = unigrams.word_shares(packed(WORDS), trie, shares)
    for k, word in enumerate(WORDS):
        ways = list(segmentations(word, pieces))
        assert len(ways) >= 1
        assert np.allclose(got[k], sum(shares[way].prod(axis=0) for way in ways))
    assert unigrams.word_shares(packed([]), trie, shares).shape == (0, 3)


def test_expected_uses(small):
    pieces, trie, shares = small
    language, uses = np.array([0, 1, 2, 0, 1, 2, 1]), np.array([3, 1, 4, 1, 5, 9, 2])
    wanted = np.zeros(shares.shape)
    for word, lang, n in zip(WORDS, language, uses, strict=True):
        ways = list(segmentations(word, pieces))
        weights = np.array([shares[way, lang].prod() for way in ways])
        for way, weight in zip(ways, n * weights / weights.sum(), strict=True):
            np.add.at(wanted[:, lang], way, weight)
    assert np.allclose(unigrams.expected_uses(packed(WORDS), trie, shares, language, uses), wanted)


def plain_words(text: str) -> list[bytes]:
    """Words of a text by one walk over its bytes."""
    found, run = [], b""
    for byte in text.lower().encode() + b" ":
        if 97 <= byte <= 122 or byte > 127:
            run += bytes([byte])
            continue
        found += [(b" " if not k else b"") + run[k : k + 32] for k in range(0, len(run), 32)]
        run = b""
    return found


@pytest.mark.parametrize("limit", [32, 64, 1 << 20])
def test_words_do_not_depend_on_slices(limit):
    draw = random.Random(limit)
    texts = ["", None, "One word; two WORDS", "x" * 300, "é" * 200 + " end", "a-b-c " * 60, "1 2 3", "ÀÉ ÎÕÜ" * 9]
    texts += ["".join(draw.choice("ab é.Z") for _ in range(draw.randint(0, 400))) for _ in range(20)]
    got = defaultdict(list)
    for first, data, offsets, goes_on in unigrams.slices(pa.array(texts, pa.string()), limit):
        words, word, text, _, _ = unigrams.distinct_words(data, offsets, goes_on)
        for w, t in zip(word, text, strict=True):
            got[first + t].append(words.data[words.offsets[w] : words.offsets[w + 1]].tobytes())
    for k, text in enumerate(texts):
        assert got[k] == plain_words(text or "")


def test_known_words_score_alike(small, monkeypatch):
    _, _, shares = small
    model = unigrams.Model(SMALL, ["x", "y", "z"], shares)
    texts = pa.array(["abc ab a", "abc c", "b c a aa", "abc ab a"])
    once = unigrams.log_shares(texts, unigrams.Scorer(model))
    scorer = unigrams.Scorer(model)
    assert np.allclose(np.vstack([unigrams.log_shares(texts.slice(k, 1), scorer) for k in range(4)]), once)
    monkeypatch.setattr(unigrams, "KNOWN_BYTES", 70)  # room for two words
    scorer = unigrams.Scorer(model)
    assert np.allclose(np.vstack([unigrams.log_shares(texts.slice(k, 1), scorer) for k in range(4)]), once)


def test_shares_of_pieces_are_proper():
    shares = unigrams.smoothed(np.array([[5.0, 0.0, 0.0], [0.0, 2.0, 0.0], [0.0, 0.0, 0.0]]))
    assert (shares > 0).all() and np.allclose(shares.sum(axis=0), 1, atol=1e-6)
    assert shares[0, 0] > shares[1, 0] and shares[1, 1] > shares[0, 1]


@pytest.fixture(scope="module")
def spoken(spark):
    syllables = {"xa": ["ka", "ki", "tu"], "xb": ["ré", "mol", "zu"], "xc": ["东", "西京", "语"]}
    draw = random.Random(2)

    def text(lang):
        gap = "" if lang == "xc" else " "
        return gap.join("".join(draw.choice(syllables[lang]) for _ in range(draw.randint(1, 4))).capitalize() for _ in range(30))

    rows = [(i, text(lang), lang, i) for i, lang in enumerate(["xa", "xb", "xc"] * 60)]
    odd = [(None, text("xa"), "xa", 0), (1000, None, "xa", 0), (1001, "", "xb", 0), (1002, "12 34 — … €", "xc", 0), (1003, text("xb"), None, 0),
           (1004, text("xc") * 3000, "xc", 0), (0, rows[0][1], "xa", 0), (1005, "ka" * 50_000, "xa", 0)]
    return spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string, score int").repartition(3)


def test_odd_rows(spark, spoken):
    model = unigrams.fit(spoken, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False)), RANKS)
    assert model.languages == ["xa", "xb", "xc"]
    found = unigrams.predict(spoken, model)
    assert found.columns == ["doc_id", "lang_pred", "score"]
    got = found.collect()
    assert len(got) == spoken.count() and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == ["xa", "xb", "xc"][i % 3] for i in range(180))
    assert (by_id[None].lang_pred, by_id[1003].lang_pred, by_id[1004].lang_pred, by_id[1005].lang_pred) == ("xa", "xb", "xc", "xa")
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert unigrams.predict(spoken.limit(0), model).count() == 0


def test_nothing_learnt(spark, spoken):
    for docs, learnt in ((spoken.limit(0), F.lit(True)), (spoken, F.lit(False)), (spoken.where("lang is null"), F.lit(True))):
        assert unigrams.fit(docs, learnt, RANKS) is None
    assert {(r.lang_pred, r.score) for r in unigrams.predict(spoken, None).collect()} == {("und", 0.0)}


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(unigrams, "LANGUAGES", 2)
    docs = spark.createDataFrame([("a b", x) for x in "pqr"], "text string, lang string")
    with pytest.raises(ValueError, match="more than 2 languages"):
        unigrams.fit(docs, F.lit(True), RANKS)


def test_held_out_accuracy(spark):
    found = QUERIES["op11_marginal_unigrams"](spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 10_000
    judged = found.where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where(r"text rlike '\\p{L}'")
    assert judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97
