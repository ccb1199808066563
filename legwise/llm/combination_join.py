"""Jaccard self-join of word-shingle sets by token-combination prefixes.

Two sets of similarity t or more share all but few shingles.  In one global order,
rare shingles first, a prefix of r + e shingles, with r allowed misses, leaves at least
e common ones in both prefixes.  Either one of them is of the rare class and is indexed
alone, or all are of the frequent class, which is indexed in combinations of two.  As
the extension e grows with the set, frequent shingles are dealt by their hash to fewer
than e groups, two common ones fall into one group, and combinations within groups
suffice: their number is linear in the set's size instead of quadratic.

1. One pass over the texts gives every text's set fingerprint; equal sets are one
   node from here on, so copies are never compared.  The same pass counts shingles
   that recur in its partitions; the often counted ones (a table of bounded size)
   come last in the order.  The order only moves work: any order gives all links.
2. The prefix index is sorted by shingle, and postings that are alone go.  Each posting
   is checked against a few leading nodes of its shingle, which is linear in the index,
   and linked nodes are contracted to components.  Families of near copies fall together
   here.
3. A shingle whose nodes are now in one component needs nothing more.  Those of few
   postings (rare class) give the pairs across components.  Of those of many (frequent
   class) each node's combinations are written as an index, combinations within one
   component or behind the first common places of every pair go, and the postings of a
   combination outside its largest component meet all others, so a large family does
   not meet itself.  Large sets share hundreds of combinations: each carries the few
   before it in its node's order, and nodes that share one of these have met there.
4. Parities of a node's shingles in 1024 bits bound the overlap of two that met; a
   pair's common prefix shingles and what is behind the prefixes bound it once more.
   Pairs that the bounds allow are verified on their whole sets.

Only links inside a component that is already known are skipped, so the components
are those of all links.  Defined results: a text without words has no shingles and
is alone; a null text is empty; repeated rows are copies; rows without an id take
part, and a component's name is its smallest id (null if it has none); other input
columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from legwise.llm.components import components
from legwise.llm.texts import blocks, shingles, words
from legwise.staging import stage

SHINGLE_WORDS = 5
SIMILARITY = Fraction(75, 100)
#: Shingles of a prefix beyond the allowed misses: at least so many, for large sets this share of the misses.
EXTRA, EXTRA_SHARE = 8, 4
#: Bits of a set's sketch, each the parity of the shingles that fall on it.
SKETCH_BITS = 1024
#: Shingles moved to the end of the order, at most, and the count from which they are.
FREQUENT_ENTRIES, FREQUENT_COUNT = 100_000, 32
#: Postings from which a shingle gives pairs only with a second one of that kind.
FREQUENT_POSTINGS = 16
#: Combinations before one in its node's order that it carries.
RECENT = 6
#: 64-bit values of the folded sketch that a combination carries.
BRIEF = 4
#: Count from which a shingle's postings are dealt over several tasks, about as many rows for each.
HOT_COUNT = 1 << 17
#: Bound of all such tasks together.
HOT_PARTS = 10_000
_COUNT_BUFFER = 1 << 21
_BLOOM_BITS = 1 << 24


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _fingerprint(members: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(members) if len(members) else 0


def _sketch(members: np.ndarray) -> np.ndarray:
    """Parities of the members on every bit, as 64-bit values."""
    places = (members & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.int64)


def _text_hashes(column: pa.Array) -> np.ndarray:
    """A hash of every text as it is; null texts are empty."""
    return np.array([xxhash.xxh3_64_intdigest(t.encode()) if t else 0 for t in column.to_pylist()], np.uint64)


def _sets(column: pa.Array, size: int):
    for block in blocks(column):
        yield from shingles(words(block), size)


class _Counts:
    """Counts of shingles that recur; each full buffer drops those seen once or twice in it."""

    def __init__(self):
        self.buffer, self.held, self.values, self.counts = [], 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, members: np.ndarray) -> None:
        self.buffer.append(members)
        self.held += len(members)
        if self.held >= _COUNT_BUFFER:
            self.merge()

    def merge(self) -> None:
        if not self.buffer:
            return
        held = np.concatenate(self.buffer)
        self.buffer = []
        held.sort()
        begins = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
        counts = np.diff(np.append(begins, len(held)))
        often = counts > 2
        values = np.concatenate([self.values, held[begins[often]]])
        order = np.argsort(values, kind="stable")
        weights = np.concatenate([self.counts, counts[often]])[order]
        self.values, begins = np.unique(values[order], return_index=True)
        self.counts = np.add.reduceat(weights, begins) if len(begins) else weights
        self.buffer, self.held = [], 0


def _first_pass(batches, size: int, key_type: pa.DataType):
    """A row per text (key, hash, set fingerprint, size and sketch), then a row per recurring shingle (shingle, count)."""
    names = ["key", "text_hash", "node", "n", "sketch", "shingle", "count"]
    wide = SKETCH_BITS // 64
    recurring = _Counts()
    for batch in batches:
        nodes, sizes, sketches = [], [], []
        for members in _sets(batch.column(1), size):
            nodes.append(_fingerprint(members))
            sizes.append(len(members))
            sketches.append(_sketch(members))
            recurring.add(members)
        sketch = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sketches) + 1, dtype=np.int32) * wide), pa.array(np.concatenate([np.zeros(0, np.int64), *sketches]))
        )
        nothing = pa.nulls(batch.num_rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), _signed(_text_hashes(batch.column(1))), _signed(np.array(nodes, np.uint64)),
             pa.array(sizes, pa.int64()), sketch, nothing, nothing], names,
        )
    recurring.merge()
    top = np.argsort(-recurring.counts, kind="stable")[:FREQUENT_ENTRIES]
    nothing = pa.nulls(len(top), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(top), key_type), nothing, nothing, nothing, pa.nulls(len(top), pa.list_(pa.int64())),
         _signed(recurring.values[top]), pa.array(recurring.counts[top])],
        names,
    )


def _prefix_length(n: int, similarity: Fraction) -> int:
    misses = n - -(-n * similarity.numerator // similarity.denominator)
    return misses + max(EXTRA, misses // EXTRA_SHARE)


def _bucket(shingle: int, part: int) -> int:
    """Signature of one part of a hot shingle's postings."""
    return xxhash.xxh3_64_intdigest(shingle.to_bytes(8, "little") + part.to_bytes(4, "little"))


def _prefixes(batches, size: int, similarity: Fraction, frequent):
    """(node, n, prefix shingles) once per distinct set of the task; prefixes begin with rare shingles."""
    late, ranks, parts = frequent.value
    hot = np.array(sorted(parts), np.uint64)
    seen: set[int] = set()
    for batch in batches:
        nodes, sizes, prefixes = [], [], []
        for members in _sets(batch.column(0), size):
            node = _fingerprint(members)
            if len(members) < 2 or node in seen:
                continue
            seen.add(node)
            length = _prefix_length(len(members), similarity)
            if len(late):
                at = np.minimum(np.searchsorted(late, members), len(late) - 1)
                rank = np.where(late[at] == members, ranks[at], 0)
                if rank[:length].any():
                    members = members[np.lexsort((members, rank))]
            prefix = members[:length].copy()
            for k in np.flatnonzero(np.isin(prefix, hot)) if len(hot) else ():
                prefix[k] = _bucket(int(prefix[k]), node % parts[int(prefix[k])])
            nodes.append(node)
            sizes.append(len(members))
            prefixes.append(prefix)
        if nodes:
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), _signed(np.concatenate(prefixes)))
            yield pa.RecordBatch.from_arrays(
                [_signed(np.array(nodes, np.uint64)), pa.array(sizes, pa.int32()), lists], ["node", "n", "prefix"]
            )


def _leaders(batches, parts: np.ndarray):
    """Postings sorted by (signature, node): each with the first node of its signature.

    The first itself has a row in the ``parts`` of hot shingles only; lone postings go.
    """
    names = ["signature", "node", "n", "place", "leader", "leader_n", "leader_place"]
    last = None  # signature, leader, its size and place, node before
    for batch in batches:
        signature, node, n, place = (batch.column(k).to_numpy() for k in range(4))
        if not len(signature):
            continue
        first = np.concatenate([[True], signature[1:] != signature[:-1]])
        if last is not None and last[0] == signature[0]:
            first[0] = False
        at = np.maximum.accumulate(np.where(first, np.arange(len(signature)), -1))
        own = [column[np.maximum(at, 0)] for column in (node, n, place)]
        if last is not None:
            own = [np.where(at < 0, held, column).astype(column.dtype) for held, column in zip(last[1:], own)]
        leader = own[0]
        before = np.concatenate([[node[0] if last is None or first[0] else last[4]], node[:-1]])
        follows = ~first & (node != before) & (node != leader)
        if len(parts):
            follows |= first & np.isin(signature, parts)
        last = signature[-1], *[column[-1] for column in own], node[-1]
        yield pa.RecordBatch.from_arrays([pa.array(c[follows]) for c in (signature, node, n, place, *own)], names)


_POSTING = "node bigint, n int, place int"


def _led(postings: DataFrame, parts: np.ndarray) -> DataFrame:
    dealt = postings.repartition("signature").sortWithinPartitions("signature", "node")
    return dealt.mapInArrow(lambda batches: _leaders(batches, parts), f"signature bigint, {_POSTING}, leader bigint, leader_n int, leader_place int")


def _joined_parts(led: DataFrame, parts: DataFrame) -> DataFrame:
    """Postings of a hot shingle's parts under its own signature, the parts' leaders led by the first of them."""
    # at most HOT_PARTS rows and one for each hot shingle
    whole = led.join(F.broadcast(parts), F.col("signature") == F.col("bucket"), "left")
    rows = whole.withColumn("signature", F.coalesce("whole", "signature")).select(*led.columns)
    heads = rows.where("node = leader").select("signature", "node", "n", "place")
    first = heads.groupBy("signature").agg(F.min_by(F.struct("node", "n", "place"), "node").alias("first"))
    joined = heads.join(first, "signature").where("node != first.node")
    return rows.where("node != leader").unionAll(joined.select("signature", "node", "n", "place", "first.*"))


def _ceil_share(size: str | Column, similarity: Fraction) -> Column:
    """Least overlap of a set of that size with a similar one."""
    size = F.col(size) if isinstance(size, str) else size
    return F.ceil(size * similarity.numerator / F.lit(similarity.denominator))


def _extra(size: Column, similarity: Fraction) -> Column:
    """Shingles of the prefix of a set of that size beyond the allowed misses."""
    return F.greatest(F.lit(EXTRA), F.floor((size - _ceil_share(size, similarity)) / F.lit(EXTRA_SHARE)))


def _common(size: Column, similarity: Fraction) -> Column:
    """Common prefix shingles that a similar pair has at least, by the size of its smaller set."""
    return F.least(_extra(size, similarity), _ceil_share(size, similarity))


def _fits(similarity: Fraction) -> Column:
    """Whether the sizes ``n`` and ``m`` allow the similarity."""
    return F.least("n", "m") * similarity.denominator >= F.greatest("n", "m") * similarity.numerator


def _possible(shared: Column, similarity: Fraction) -> Column:
    """Whether sets of sizes ``n`` and ``m`` with so many common prefix shingles may reach the similarity.

    Of the prefix that ends first, every common shingle is in both, so the others lie
    behind it.
    """
    p, q = similarity.numerator, similarity.denominator
    behind = [  # n less its prefix
        F.greatest(_ceil_share(size, similarity) - _extra(F.col(size), similarity), F.lit(0)) for size in ("n", "m")
    ]
    overlap = F.least(shared + F.greatest(*behind), F.col("n"), F.col("m"))
    return overlap * (p + q) >= (F.col("n") + F.col("m")) * p


def _least_shared(similarity: Fraction) -> Column:
    """Common prefix shingles that a set of size ``n`` has with any similar one, of which the smallest has ``_ceil_share``."""
    return _common(_ceil_share("n", similarity), similarity)


def _near(similarity: Fraction, wide: int = SKETCH_BITS // 64) -> Column:
    """Whether the sketches, of so many 64-bit values, of sets of sizes ``n`` and ``m`` allow the similarity.

    A shingle of one of the sets alone changes one parity, so as many bits as differ at
    least are such shingles.
    """
    p, q = similarity.numerator, similarity.denominator
    apart = sum(F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("sketch_2")[k])) for k in range(wide))
    return (F.col("n") + F.col("m") - apart) * (p + q) >= (F.col("n") + F.col("m")) * (2 * p)


def _brief(sketches: DataFrame) -> DataFrame:
    """The sketches folded to ``BRIEF`` values, parities again."""
    folds = range(0, SKETCH_BITS // 64, BRIEF)
    folded = [F.expr(" ^ ".join(f"sketch[{k + fold}]" for fold in folds)) for k in range(BRIEF)]
    return sketches.select("node", F.array(*folded).alias("sketch"))


def _able(postings: DataFrame, similarity: Fraction, *more: Column) -> DataFrame:
    """The postings of nodes that have as many, ``opened``, as a similar pair shares at least."""
    per_node = postings.groupBy("node").agg(F.count(F.lit(1)).alias("opened"), *more)
    return postings.join(per_node, "node").where(F.col("opened") >= _least_shared(similarity))


def _open(postings: DataFrame, known: DataFrame) -> DataFrame:
    """The postings of signatures whose nodes are of several components, with component and ``postings``, their number."""
    named = postings.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spans = named.groupBy("signature").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("postings")
    ).where("low < high")
    return stage(named.join(spans.select("signature", "postings"), "signature"), "open")


def _to_leaders(postings: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs of a node and a leader of one of its signatures that may be similar.

    A signature's leaders are its most central node, the one whose signatures have the
    most postings, as the original of a family of copies has, and its first node in a
    random order of all nodes.  Pairs that are not tried here are found across
    components later.
    """
    sizes = postings.groupBy("signature").agg(F.count(F.lit(1)).alias("postings"))
    central = postings.join(sizes, "signature").groupBy("node").agg(F.sum("postings").alias("central"))
    ranked = postings.join(central, "node")
    node = F.struct("node", "n")
    first = F.max_by(node, F.struct("central", "node")), F.min_by(node, F.xxhash64("node"))
    leaders = ranked.groupBy("signature").agg(F.array(*first).alias("leaders"))
    led = postings.join(leaders, "signature").select("node", "n", F.explode(F.array_distinct("leaders")).alias("leader"))
    sized = led.where("node != leader.node").select(
        F.col("node").alias("a"), F.col("leader.node").alias("b"), "n", F.col("leader.n").alias("m")
    )
    counted = sized.where(_fits(similarity)).groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where(_possible(F.col("shared"), similarity)).select("a", "b")


def _level(size: Column, similarity: Fraction) -> Column:
    """Binary logarithm of the number of groups for pairs whose smaller set has that size; fewer groups than common shingles."""
    return F.length(F.bin(F.greatest(_common(size, similarity) - 1, F.lit(1)))) - 1


def _needed(size: Column, similarity: Fraction) -> Column:
    """Common prefix shingles of which one is rare or two fall into one group, one more than groups."""
    return F.pow(F.lit(2), _level(size, similarity)).cast("int") + 1


def _combinations(many: DataFrame, similarity: Fraction) -> DataFrame:
    """The index of two-shingle combinations: ``many`` postings' nodes with each ``pair`` of shingles of one group.

    A set is dealt in the number of groups of every size that the smaller set of a pair
    of its may have.  ``far`` is the later place of the two shingles in the prefix; places
    behind the first needed ones of any pair are not dealt.
    """
    p, q = similarity.numerator, similarity.denominator
    levels = F.sequence(_level(_ceil_share("n", similarity), similarity), _level(F.col("n"), similarity))
    leveled = many.withColumn("level", F.explode(levels))
    part = F.pmod(F.xxhash64("signature"), F.expr("shiftleft(1, level)"))
    own = [c for c in many.columns if c not in ("signature", "postings", "place")]
    place = F.col("place") if "place" in many.columns else F.lit(0)
    listed = F.sort_array(F.collect_list(F.struct("signature", place.alias("place"))))
    overlap = F.ceil((F.col("n") + _ceil_share("n", similarity)) * p / F.lit(p + q))  # with the smallest set
    leveled = leveled.where(place < F.col("n") - overlap + F.expr("shiftleft(1, level)") + 1)
    dealt = leveled.groupBy(*own, "level", part.alias("part")).agg(listed.alias("group"))
    pairs = (
        "flatten(transform(group, (x, i) -> transform(slice(group, i + 2, size(group)), "
        "y -> struct(xxhash64(level, x.signature, y.signature) AS pair, greatest(x.place, y.place) AS far))))"
    )
    return dealt.select(*own, "level", F.inline(F.expr(pairs)))


def _beginning(size: Column, similarity: Fraction) -> Column:
    """Places of a set of that size before which its first needed shingles, common with any larger similar set, lie."""
    p, q = similarity.numerator, similarity.denominator
    # the smaller set of a pair overlaps by 2 t / (1 + t) of its size at least
    return size - F.ceil(size * (2 * p) / F.lit(p + q)) + _needed(size, similarity)


def _outside(index: DataFrame, similarity: Fraction) -> DataFrame:
    """The rows of ``index`` that may meet one of another component, with ``largest``, the component of most of its nodes.

    The smaller set of a pair meets at its own level with places at its beginning, so a
    combination needs such a row, and other rows one of a size that fits theirs.
    """
    p, q = similarity.numerator, similarity.denominator
    smaller = (F.col("level") == _level(F.col("n"), similarity)) & (F.col("far") < _beginning(F.col("n"), similarity))
    index = index.withColumn("smaller", smaller)
    size = F.when(F.col("smaller"), F.col("n"))
    per_pair = index.groupBy("pair", "component").agg(F.count(F.lit(1)).alias("nodes"), F.min(size).alias("least"), F.max(size).alias("most"))
    spans = per_pair.groupBy("pair").agg(
        F.max(F.struct("nodes", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("several"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    ).where("several > 1 AND least IS NOT NULL").select(F.col("pair").alias("_pair"), "largest", "least", "most")
    fits = (F.col("least") <= F.col("n")) & (F.col("most") * q >= F.col("n") * p)
    met = (F.col("pair") == F.col("_pair")) & (F.col("smaller") | fits)
    return index.join(spans, met).drop("_pair", "least", "most", "smaller")


def _recent(index: DataFrame) -> DataFrame:
    """The ``index`` with ``recent``, the combinations last before each in its node's order by place.

    Two nodes with a common recent one may meet there as well as here, and at earlier
    places: of all combinations that they share, the first has none.
    """
    before = Window.partitionBy("node", "level").orderBy("far", "pair").rowsBetween(-RECENT, -1)
    return index.withColumn("recent", F.collect_list("pair").over(before))


def _renamed(postings: DataFrame, *keys: str) -> DataFrame:
    """The postings as the second side of a join: ``m`` is the size, other columns end with ``_2``."""
    others = [F.col(c).alias("m" if c == "n" else f"{c}_2") for c in postings.columns if c not in keys]
    return postings.select(*keys, *others)


def _across(open_: DataFrame, similarity: Fraction, frequent_postings: int, sketches: DataFrame | None = None) -> DataFrame:
    """Pairs of nodes of different components that may be similar.

    Rare signatures give pairs alone, frequent ones in combinations of two.  The first
    common signatures, one more than groups and no more than a similar pair shares, are at
    the beginnings of the prefixes; if none of them is rare, two are in one group.  A pair
    shares no more signatures than either node has open ones, which rules out most nodes
    and pairs before they are formed, and the sketches and the common signatures of their
    whole prefixes most others.  The nodes of a pair meet about once, however many
    combinations they share; the whole sketches are met by pairs and not by combinations.
    """
    p, q = similarity.numerator, similarity.denominator
    able = stage(_able(open_, similarity), "able")
    differ = (F.col("component") != F.col("component_2")) & _fits(similarity) & _possible(F.least("opened", "opened_2"), similarity)
    needed = _needed(F.least("n", "m"), similarity)

    rare = able.where(F.col("postings") <= frequent_postings).drop("postings")
    overlap = F.ceil((F.col("n") + F.col("m")) * p / F.lit(p + q))  # of a similar pair; so much lies behind its first place

    def placed(place: str) -> Column:
        return (F.col(place) < F.col("n") - overlap + needed) & (F.col(f"{place}_2") < F.col("m") - overlap + needed)

    ordered = F.expr("n < m OR n = m AND node < node_2")
    early = rare.where(F.col("place") < _beginning(F.col("n"), similarity))
    alone = early.join(_renamed(rare, "signature"), "signature").where(ordered & differ & placed("place"))

    many = able.where(F.col("postings") > frequent_postings)
    index = _outside(stage(_combinations(many, similarity), "combinations"), similarity)
    if sketches is not None:
        index = index.join(_brief(sketches), "node")
    index = stage(_recent(index), "index")
    # a pair of the largest component's nodes never meets; of a pair with one of them, that one is the second
    once = F.expr("component_2 = largest OR node < node_2")
    groups = F.col("level") == F.least(*[_level(F.col(size), similarity) for size in ("n", "m")])
    seconds = _renamed(index.drop("level", "largest"), "pair")
    met = once & groups & differ & placed("far")
    if sketches is not None:
        met &= _near(similarity, BRIEF)
    met &= ~F.arrays_overlap("recent", "recent_2")
    combined = index.where("component != largest").join(seconds, "pair").where(met)

    found = [met.select(F.col("node").alias("a"), F.col("node_2").alias("b"), "n", "m") for met in (alone, combined)]
    pairs = found[0].unionAll(found[1]).distinct()
    if sketches is not None:
        of_b = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_2"))
        sketched = pairs.join(sketches.withColumnRenamed("node", "a"), "a").join(of_b, "b")
        pairs = sketched.where(_near(similarity)).drop("sketch", "sketch_2")
    prefixes = able.groupBy("node").agg(F.collect_list("signature").alias("prefix"))  # a node's prefix at most
    first = prefixes.select(F.col("node").alias("a"), F.col("prefix").alias("of_a"))
    second = prefixes.select(F.col("node").alias("b"), F.col("prefix").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(first, "a").join(second, "b").where(_possible(shared, similarity)).select("a", "b")


def _whole_sets(batches, size: int, wanted):
    """(node, members) of the texts whose hash may be wanted; once per task."""
    bits = np.frombuffer(wanted.value, np.uint8)
    seen: set[int] = set()
    for batch in batches:
        hashes = _text_hashes(batch.column(0))
        keep = np.ones(len(hashes), bool)
        for at in _bloom_places(hashes):
            keep &= (bits[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8) & 128) > 0
        keep &= np.array([not (h in seen or seen.add(h)) for h in hashes.tolist()], bool)
        for block in blocks(batch.column(0).filter(pa.array(keep))):
            nodes, lists = [], []
            for members in shingles(words(block), size):
                nodes.append(_fingerprint(members))
                lists.append(members)
            offsets = np.concatenate([[0], np.cumsum([len(m) for m in lists])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [_signed(np.array(nodes, np.uint64)),
                 pa.ListArray.from_arrays(pa.array(offsets), _signed(np.concatenate([np.zeros(0, np.uint64), *lists])))],
                ["node", "members"],
            )


def _bloom_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of every hash."""
    return hashes & np.uint64(_BLOOM_BITS - 1), (hashes >> np.uint64(32)) & np.uint64(_BLOOM_BITS - 1)


def _bloom(batches):
    """Bits of this task's hashes as one row of bounded size."""
    bits = np.zeros(_BLOOM_BITS, bool)
    for batch in batches:
        hashes = batch.column(0).to_numpy().view(np.uint64)
        for at in _bloom_places(hashes):
            bits[at] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()])], ["bits"])


def _sets_of(nodes: DataFrame, texts: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """``node`` and ``members`` of every set among ``nodes``, from one of its texts.

    A Bloom filter of bounded size over the texts' hashes goes to the scan, so that only
    texts of such sets are read into sets and shuffled.
    """
    spark = texts.sparkSession
    nodes = stage(nodes, "nodes")
    one_text = rows.where("n > 0").groupBy("node").agg(F.min("text_hash").alias("text_hash"))
    hashes = one_text.join(nodes, "node").select("text_hash")
    bits = np.zeros(_BLOOM_BITS // 8, np.uint8)
    for row in hashes.coalesce(8).mapInArrow(_bloom, "bits binary").collect():  # at most eight rows of two megabytes
        bits |= np.frombuffer(row.bits, np.uint8)
    wanted = spark.sparkContext.broadcast(bits.tobytes())
    found = texts.mapInArrow(lambda batches: _whole_sets(batches, size, wanted), "node bigint, members array<bigint>")
    sets = stage(found.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sets")
    wanted.unpersist()
    return sets


def _similar(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""
    first = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    second = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    linked = common * similarity.denominator >= union * similarity.numerator
    return pairs.join(second, "b").join(first, "a").where(linked).select("a", "b")


def _joined(known: DataFrame, more: DataFrame) -> DataFrame:
    """The ``known`` components joined by ``more`` links; only the links between components are walked again."""
    of = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
    named = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b")
    )
    named = stage(named, "between")
    whole = stage(components(named.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "whole")
    lone = named.select(F.explode(F.array(F.struct("a", "of_a"), F.struct(F.col("b").alias("a"), F.col("of_b").alias("of_a")))).alias("side"))
    lone = lone.select(F.col("side.a").alias("node"), F.col("side.of_a").alias("component")).where("node = component").distinct()
    every = known.unionAll(lone.join(known, "node", "left_anti"))
    joined = every.join(whole.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    return joined.select("node", F.coalesce("root", "component").alias("component"))


def linked_sets(
    texts: DataFrame, rows: DataFrame, size: int, similarity: Fraction, frequent_postings: int = FREQUENT_POSTINGS
) -> DataFrame:
    """``node`` and ``component`` of every set with a link; ``texts`` has one column, ``rows`` the first pass."""
    spark = texts.sparkSession
    often = (
        rows.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("count").alias("count"))
        .where(F.col("count") >= FREQUENT_COUNT).orderBy(F.desc("count"), "shingle").limit(FREQUENT_ENTRIES)
    ).toPandas()
    late = often["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(late)
    ranks = np.ceil(np.log2(np.maximum(often["count"].to_numpy(np.float64), 1)))[order].astype(np.int64)
    least = max(HOT_COUNT, int(often["count"].sum()) // HOT_PARTS)
    parts = {int(s): -(-int(c) // least) for s, c in zip(late, often["count"]) if c > least}
    frequent = spark.sparkContext.broadcast((late[order], ranks, parts))
    signed = lambda value: value - (1 << 64) if value >> 63 else value
    named_parts = [(signed(_bucket(s, k)), signed(s)) for s, n in parts.items() for k in range(n)]
    buckets = np.array([b for b, _ in named_parts], np.int64)
    indexed = texts.mapInArrow(
        lambda batches: _prefixes(batches, size, similarity, frequent), "node bigint, n int, prefix array<bigint>"
    )
    placed = indexed.select("node", "n", F.posexplode("prefix").alias("place", "signature"))
    led = stage(_led(placed.select("signature", "node", "n", "place"), buckets), "prefixes")
    frequent.unpersist()
    if named_parts:
        led = _joined_parts(led, spark.createDataFrame(named_parts, "bucket bigint, whole bigint"))

    leaders = led.select("signature", *[F.col(f"leader{c}") for c in ("", "_n", "_place")]).distinct()
    postings = led.select("signature", "node", "n", "place").unionAll(leaders)
    able = stage(_able(postings, similarity).drop("opened"), "postings")

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs, "pairs")
        nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
        return stage(_similar(pairs, _sets_of(nodes, texts, rows, size), similarity), "links")

    known = stage(components(links_of(_to_leaders(able, similarity))), "known")
    sketches = rows.where("n > 1").select("node", "sketch").dropDuplicates(["node"])
    more = links_of(_across(_open(able, known), similarity, frequent_postings, sketches))
    return _joined(known, more)


def group(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    size: int = SHINGLE_WORDS,
    similarity: Fraction = SIMILARITY,
    frequent_postings: int = FREQUENT_POSTINGS,
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (smallest key of its component) of every row."""
    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = chosen.schema["key"].dataType
    key_type = to_arrow_type(kind)
    fields = StructType.fromDDL("text_hash bigint, node bigint, n bigint, sketch array<bigint>, shingle bigint, count bigint").fields
    first = chosen.mapInArrow(lambda batches: _first_pass(batches, size, key_type), StructType([StructField("key", kind), *fields]))
    rows = stage(first, "fingerprints")
    found = linked_sets(chosen.select("text"), rows, size, similarity, frequent_postings)
    texts = rows.where("node IS NOT NULL").select("key", "node", "n")
    named = texts.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("n > 0").groupBy("component").agg(F.min("key").alias("least"))
    owner = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key"))
    return named.join(least, "component", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), owner.alias("component_id")
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of ``docs``, that of the smallest key, with its own columns.

    The numbered rows are written: the numbers of a second scan may be others.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # no name of a column can meet one of ours
    numbered = stage(docs.select(row, F.monotonically_increasing_id().alias("number")), "numbered")
    given = F.col("row")[key]
    order = F.struct(given.isNull().alias("unknown"), given.alias("key"), "number")
    found = group(numbered.select(order.alias("place"), F.col("row")[text].alias("text")), "text", "place")
    first = found.where(F.col("place") == F.col("component_id")).select("place.number")
    return numbered.join(first, "number", "left_semi").select("row.*")
