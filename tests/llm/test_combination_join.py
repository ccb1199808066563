"""The set join against all pairs on small tables."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from legwise.llm import combination_join
from legwise.llm.components import components


def shingle_set(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def plain_components(sets):
    """Smallest position reachable, over all pairs."""
    owner = list(range(len(sets)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = sorted((root(i), root(j)))
            owner[b] = a
    return [root(i) for i in range(len(sets))]


def corpus(seed, families=12, extra=40):
    """Near copies by chains of edits, shared lines, short texts, and copies."""
    draw = random.Random(seed)
    some = lambda n, pool="abcdefghijkl": " ".join(draw.choice(pool) + draw.choice(pool) for _ in range(n))
    lines = [some(9) for _ in range(4)]
    texts = []
    for _ in range(families):
        text = (draw.choice(lines) + " " + some(draw.randint(3, 60))).split()
        for _ in range(draw.randint(1, 14)):
            texts.append(" ".join(text) if draw.random() < 0.7 else "  ".join(text).upper())
            for _ in range(draw.randint(0, 2)):
                place = draw.randrange(len(text))
                text = [*text[:place], some(1), *text[place + draw.randint(0, 1) :]]
    texts += [draw.choice(lines) + " " + some(draw.randint(0, 4)) for _ in range(extra)]
    texts += ["", None, "   \n", "one two", "ONE\ttwo", "one two three", texts[0], texts[0]]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "limit", "hot"), [(1, 16, 1 << 17), (2, 1, 1 << 17), (3, 2, 8), (4, 1, 4)])
def test_all_links_are_found(spark, monkeypatch, seed, limit, hot):
    monkeypatch.setattr(combination_join, "FREQUENT_COUNT", 6)
    monkeypatch.setattr(combination_join, "HOT_COUNT", hot)
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)], "doc_id bigint, text string, node string, n int").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in combination_join.group(df, frequent_postings=limit).collect()}
    sets = [shingle_set(t) for t in texts]
    assert got == {i: (len(sets[i]), c) for i, c in enumerate(plain_components(sets))}
    assert len({c for _, c in got.values()}) < len(texts) - 20


@pytest.mark.parametrize("signed", [(-5, 7, 9), (9, 7, -5)])
def test_pairs_of_unequal_sets_meet_at_their_first_common_shingle(spark, signed):
    """Ranks order the prefix, not signed hashes: any sign may come first; the last shingle is behind the allowed places."""
    at_a, at_b = (0, 1, 3), (0, 1, 7)
    rows = [(s, 1, 20, a, 1) for s, a in zip(signed, at_a)] + [(s, 2, 24, b, 2) for s, b in zip(signed, at_b)]
    rows += [(100 + k, node, n, 10 + k, node) for node, n in ((1, 20), (2, 24)) for k in range(6)]
    open_ = spark.createDataFrame(rows, "signature bigint, node bigint, n int, place int, component bigint")
    open_ = open_.withColumn("postings", F.lit(50))
    got = combination_join._across(open_, combination_join.SIMILARITY, 40).collect()
    assert [(r.a, r.b) for r in got] == [(1, 2)]


def test_odd_tables(spark):
    kind = "doc_id bigint, text string"
    assert combination_join.group(spark.createDataFrame([], kind)).count() == 0
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (None, None), (3, ""), (None, "lonely text"), (9, long), (8, long + " x")]
    got = sorted(map(repr, (tuple(r) for r in combination_join.group(spark.createDataFrame(rows, kind)).collect())))
    expected = [(None, 2, 7), (7, 2, 7), (7, 2, 7), (None, 0, None), (3, 0, 3), (None, 1, None), (9, 29_996, 8), (8, 29_997, 8)]
    assert got == sorted(map(repr, expected))


def test_kept_rows_do_not_depend_on_how_files_are_split(spark, tmp_path):
    rows = [(i, f"text {i if i % 3 else i // 6} of its own words and more") for i in range(120)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12, "doc_id").write.parquet(str(tmp_path / "docs"))
    kept = combination_join.keep_one(spark.read.parquet(str(tmp_path / "docs")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a second scan would get other partitions
    try:
        got = sorted(tuple(r) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first = {}
    for i, text in rows:
        first.setdefault(text, (i, text))
    assert got == sorted(first.values())


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(139, 200), (300, 300)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys([*range(100, 140), 200], 100)}


def test_kept_rows_keep_every_column(spark):
    names = ["_row", "row", "number", "key", "place", "node", "n", "a.b"]
    text = "one two three four five six seven"
    df = spark.createDataFrame([(i, text if i < 3 else f"{text} {i} " * i, *[f"{n}{i}" for n in names]) for i in range(6)], ["doc_id", "text", *names])
    kept = combination_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r._row for r in kept.collect()) == ["_row0", "_row3", "_row4", "_row5"]


def test_pairs_with_the_least_common_shingles_share_a_combination(spark):
    """Sizes around the steps of the number of groups; no rare shingle helps."""
    draw, t = random.Random(7), combination_join.SIMILARITY
    sizes = [(n, m) for n in (2, 3, 9, 11, 40, 131, 144, 257, 300, 700) for m in (n, n + 1, n * 4 // 3) if n * 4 >= m * 3]
    rows = []
    for k, (n, m) in enumerate(sizes):
        misses = n - -(-3 * n // 4)
        least = min(max(8, misses // 4), -(-3 * n // 4))
        common = [draw.getrandbits(62) for _ in range(least)]
        rows += [(s, 2 * k + side, size, 2 * k + side) for side, size in enumerate((n, m)) for s in common]
    many = spark.createDataFrame(rows, "signature bigint, node bigint, n int, component bigint")
    index = combination_join._combinations(many, t)
    met = {(r.node // 2, r.pair): set() for r in index.collect()}
    for r in index.collect():
        met[r.node // 2, r.pair].add((r.node % 2, r.level))
    level = {}
    for r in many.select("n", combination_join._level(F.col("n"), t).alias("level")).distinct().collect():
        level[r.n] = r.level
    for k, (n, _) in enumerate(sizes):
        assert any(found == {(0, level[n]), (1, level[n])} for (of, _), found in met.items() if of == k), sizes[k]


def test_sketches_never_rule_out_a_similar_pair(spark):
    draw, rows = random.Random(3), []
    for k in range(300):
        n, changed = draw.randint(2, 900), draw.random() * 0.4
        a = {draw.getrandbits(63) for _ in range(n)}
        b = {x if draw.random() > changed else draw.getrandbits(63) for x in a}
        similar = 100 * len(a & b) >= 75 * len(a | b)
        sketch = [combination_join._sketch(np.array(sorted(s), np.uint64)).tolist() for s in (a, b)]
        rows.append((len(a), len(b), *sketch, similar))
    df = spark.createDataFrame(rows, "n int, m int, sketch array<bigint>, sketch_2 array<bigint>, similar boolean")
    got = df.select("similar", combination_join._near(combination_join.SIMILARITY).alias("near")).collect()
    assert all(r.near for r in got if r.similar) and any(r.similar for r in got)
    assert not all(r.near for r in got)


def test_combinations_behind_the_first_common_places_are_not_kept(spark):
    """Two similar sets of 100 have their first 8 common shingles before place 22: they overlap by 86 at least."""
    level = spark.range(1).select(combination_join._level(F.lit(100), combination_join.SIMILARITY)).first()[0]
    spots = {1: (30, 30), 2: (5, 30), 3: (5, 5)}  # pair: places of two components' nodes
    rows = [(10 * pair + side, 100, 10 * pair + side, level, pair, far) for pair, places in spots.items() for side, far in enumerate(places)]
    rows += [(99, 100, 30, level, 3, 40), (98, 200, 98, level, 3, 5)]  # the larger component of pair 3, and a set too large for it
    index = spark.createDataFrame(rows, "node bigint, n int, component bigint, level int, pair bigint, far int")
    kept = combination_join._outside(index, combination_join.SIMILARITY).collect()
    assert sorted((r.pair, r.node, r.largest) for r in kept) == [(2, 20, 21), (2, 21, 21), (3, 30, 30), (3, 31, 30), (3, 99, 30)]


@pytest.mark.parametrize("recent", [1, 8])
def test_nodes_that_share_many_combinations_meet_few_times(spark, monkeypatch, recent):
    """Families of large sets that are not similar: every pair meets, but not once for each of its hundreds of combinations."""
    monkeypatch.setattr(combination_join, "RECENT", recent)
    draw, met, stage = random.Random(5), [], combination_join.stage
    common = list(range(1000, 1420))
    rows = []
    for node in range(12):
        mine = sorted([s for s in common if draw.random() < 0.95] + [draw.randrange(10**6) + 2000 for _ in range(20)])
        rows += [(s, node, 2000, place, node, 50) for place, s in enumerate(mine)]
    open_ = spark.createDataFrame(rows, "signature bigint, node bigint, n int, place int, component bigint, postings bigint")

    def kept(df, label):
        written = stage(df, label)
        if label == "index":
            met.append(written)
        return written

    monkeypatch.setattr(combination_join, "stage", kept)
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in combination_join._across(open_, combination_join.SIMILARITY, 16).collect()}
    assert got == set(combinations(range(12), 2))
    first = met[0].select("node", "pair", "recent").where("node < 12")
    second = first.toDF("node_2", "pair", "recent_2")
    shared = first.join(second, "pair").where("node < node_2")
    kept_rows = shared.where(~F.arrays_overlap("recent", "recent_2"))
    assert kept_rows.select("node", "node_2").distinct().count() == 66
    assert kept_rows.count() * (2 if recent == 1 else 20) < shared.count()


def test_folded_sketches_never_rule_out_a_similar_pair(spark):
    draw, rows, t = random.Random(4), [], combination_join.SIMILARITY
    for k in range(200):
        n, changed = draw.randint(2, 300), draw.random() * 0.4
        a = {draw.getrandbits(63) for _ in range(n)}
        b = {x if draw.random() > changed else draw.getrandbits(63) for x in a}
        similar = 100 * len(a & b) >= 75 * len(a | b)
        rows += [(2 * k + side, k, len(s), combination_join._sketch(np.array(sorted(s), np.uint64)).tolist(), similar) for side, s in enumerate((a, b))]
    df = spark.createDataFrame(rows, "node int, k int, n int, sketch array<bigint>, similar boolean")
    folded = df.drop("sketch").join(combination_join._brief(df), "node")
    pairs = folded.where("node % 2 = 0").join(folded.where("node % 2 = 1").selectExpr("k", "n AS m", "sketch AS sketch_2"), "k")
    got = pairs.select("similar", combination_join._near(t, combination_join.BRIEF).alias("near")).collect()
    assert len(got) == 200 and all(r.near for r in got if r.similar) and any(r.similar for r in got)
    assert not all(r.near for r in got)
