"""Benchmark decontamination by greedy string tiling.

Windows of ``min_match`` words are hashed (Karp-Rabin) on both sides; equal hashes
are the seeds of a document and a benchmark item.  Seeds on one diagonal join to
maximal matches.  The longest match is marked first, and what is left of the others
outside marked words is tried again until nothing of ``min_match`` words remains.
The marked share of the item's words is its coverage: a passage whose sentences were
moved around is covered as fully as a copy.

Items are handled in blocks of bounded size: each block's window table is broadcast
and meets all documents, so documents are never shuffled and no pairs without a
common seed are formed.  A pair is tiled only if the item's windows that the document
has cover enough of the item's words, which no tiling can exceed.

Words are runs of letters, digits and non-ASCII characters, without case.  Defined
results: texts without words match nothing; an item shorter than ``min_match`` words
must occur whole; repeated rows on either side give repeated rows; other input
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from legwise.llm.texts import Block, Words, blocks, prefix_hash, span_hash, window_hashes, word_spans

MIN_MATCH = 5
#: Share of an item's words that contaminates a document.
COVERAGE = 0.6
#: Bytes of benchmark text in a broadcast block.
BLOCK_BYTES = 4 << 20
_FILTER_BITS = 22

LETTERS_ONLY = np.ones(256, bool)
LETTERS_ONLY[128:] = False
for _low, _high in ((48, 57), (65, 90), (97, 122)):
    LETTERS_ONLY[_low : _high + 1] = False


def _words(block: Block) -> Words:
    starts, ends, bounds = word_spans(block.data, block.offsets, LETTERS_ONLY)
    return Words(starts, ends, span_hash(prefix_hash(block.data), starts, ends), bounds)


class Items:
    """Word hashes of a block of items, and their windows by size."""

    def __init__(self, texts: list[str], min_match: int):
        self.min_match, self.hashes = min_match, []
        for block in blocks(pa.array(texts, pa.large_string())):
            table = _words(block)
            bounds = table.bounds
            self.hashes += [table.hashes[bounds[k] : bounds[k + 1]] for k in range(len(bounds) - 1)]
        by_size: dict[int, list] = defaultdict(list)
        for item, hashes in enumerate(self.hashes):
            if len(hashes):
                size = min(min_match, len(hashes))
                windows = window_hashes(hashes, size)
                by_size[size].append((windows, np.full(len(windows), item), np.arange(len(windows))))
        self.windows = {}
        for size, parts in by_size.items():
            windows, items, places = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(windows, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[windows & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.windows[size] = windows[order], items[order], places[order], seen

    def _met(self, size: int, mine: np.ndarray):
        """Which of the window hashes the items have, and the range of their entries in the table."""
        windows, _, _, seen = self.windows[size]
        at = np.flatnonzero(seen[mine & np.uint64((1 << _FILTER_BITS) - 1)])
        low = np.searchsorted(windows, mine[at], "left")
        count = np.searchsorted(windows, mine[at], "right") - low
        return at[count > 0], low[count > 0], count[count > 0]

    def seeds(self, words: Words, threshold: float):
        """For each window size: document, window place, item and item place of every common window of the pairs
        that can reach the threshold.

        A pair's covered words lie in the item's windows that the document has.  These are counted
        from a document's different windows, so one that occurs often is not multiplied with
        all items; its occurrences are set against the items of the remaining pairs alone.
        """
        totals = np.array([len(h) for h in self.hashes], np.int64)
        for size, (_, items, item_places, _) in self.windows.items():
            mine = window_hashes(words.hashes, size)
            at, low, count = self._met(size, mine)
            document = np.searchsorted(words.bounds, at, "right") - 1
            inside = at + size <= words.bounds[document + 1]  # no window over two texts
            at, low, count, document = at[inside], low[inside], count[inside], document[inside]
            begins = np.flatnonzero(np.diff(document, prepend=-1))
            for first, last in zip(begins, np.append(begins[1:], len(at))):
                # entries of the table are numbered by window, so equal windows have equal ``low``
                kinds, which = np.unique(low[first:last], return_inverse=True)
                each = np.zeros(len(kinds), np.int64)
                each[which] = count[first:last]
                entries = _ranges(kinds, each)
                order = np.lexsort((item_places[entries], items[entries]))
                pair_items, pair_places = items[entries][order], item_places[entries][order]
                same = np.diff(pair_items, append=-1) == 0
                reach = np.where(same, np.minimum(np.diff(pair_places, append=0), size), size)
                starts = np.flatnonzero(np.diff(pair_items, prepend=-1))
                found = pair_items[starts]
                able = found[np.add.reduceat(reach, starts) >= threshold * totals[found]]
                if not len(able):
                    continue
                keep = np.isin(items[entries], able)
                chosen, kind = entries[keep], np.repeat(np.arange(len(kinds)), each)[keep]
                per_kind = np.bincount(kind, minlength=len(kinds))
                starts = np.concatenate([[0], np.cumsum(per_kind)[:-1]])
                spread = _ranges(starts[which], per_kind[which])
                places = np.repeat(at[first:last], per_kind[which])
                yield size, int(document[first]), places, items[chosen[spread]], item_places[chosen[spread]]


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``low``, ``low + 1``, ... of each range, ``count`` numbers of it, one range after the other."""
    return np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())


def matches(size: int, places: np.ndarray, item_places: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal matches (item place, document place, length) of one pair from its seeds."""
    order = np.lexsort((places, places - item_places))
    places, item_places = places[order], item_places[order]
    same = (np.diff(places) == 1) & (np.diff(places - item_places) == 0)
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    lengths = np.diff(np.append(begins, len(places))) + size - 1
    return list(zip(item_places[begins].tolist(), places[begins].tolist(), lengths.tolist()))


def _free(marked: np.ndarray, other: np.ndarray, i: int, j: int, length: int) -> list[tuple[int, int]]:
    """Runs (shift, length) of the match that are marked on neither side."""
    taken = marked[i : i + length] | other[j : j + length]
    edges = np.flatnonzero(np.diff(np.concatenate([[1], taken.astype(np.int8), [1]])))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


def tiles(found: list[tuple[int, int, int]], item_words: int, document_words: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: the longest unmarked match first, ties by place."""
    in_item, in_document = np.zeros(item_words, bool), np.zeros(document_words, bool)
    heap = [(-length, i, j) for i, j, length in found]
    heapq.heapify(heap)
    chosen = []
    while heap:
        length, i, j = heapq.heappop(heap)
        free = _free(in_item, in_document, i, j, -length)
        if free == [(0, -length)]:
            in_item[i : i - length] = in_document[j : j - length] = True
            chosen.append((i, j, -length))
            continue
        for shift, rest in free:
            if rest >= least:
                heapq.heappush(heap, (-rest, i + shift, j + shift))
    return chosen


def _covering(column: pa.Array, table: Items, threshold: float):
    """Row, item, item's words, covered words and tiles of every pair that reaches the threshold."""
    for block in blocks(column):
        words = _words(block)
        for size, k, at, which, places in table.seeds(words, threshold):
            start, end = int(words.bounds[k]), int(words.bounds[k + 1])
            order = np.argsort(which, kind="stable")
            which, at, places = which[order], at[order], places[order]
            begins = np.flatnonzero(np.diff(which, prepend=-1))
            for low, high in zip(begins, np.append(begins[1:], len(which))):
                item = int(which[low])
                total = len(table.hashes[item])
                found = matches(size, at[low:high] - start, places[low:high])
                chosen = tiles(found, total, end - start, min(table.min_match, total))
                covered = sum(length for _, _, length in chosen)
                if covered >= threshold * total:
                    yield block.first + k, item, total, covered, chosen


def _tiled(batches, items, ids: list, id_type: pa.DataType, threshold: float):
    names = ["key", "item", "item_words", "covered_words", "coverage", "tiles"]
    tile_type = pa.list_(pa.struct([("item_word", pa.int32()), ("document_word", pa.int32()), ("words", pa.int32())]))
    for batch in batches:
        found = list(_covering(batch.column(1), items.value, threshold))
        if found:
            rows, item, total, covered, chosen = zip(*found)
            spans = [[{"item_word": i, "document_word": j, "words": n} for i, j, n in sorted(c)] for c in chosen]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array([ids[i] for i in item], id_type), pa.array(total, pa.int64()),
                 pa.array(covered, pa.int64()), pa.array([c / t for c, t in zip(covered, total)], pa.float64()),
                 pa.array(spans, tile_type)],
                names,
            )


def _item_blocks(benchmark: DataFrame, item_text: str, item_key: str, min_match: int, block_bytes: int):
    """Broadcast windows and ids of each block of the benchmark."""
    items = benchmark.select(F.col(f"`{item_key}`").alias("item"), F.lower(F.col(f"`{item_text}`").cast("string")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for k in range(count):
        # a bounded part of the benchmark, see ``block_bytes``
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k).orderBy("item", "text").collect()
        windows = Items([r.text or "" for r in rows], min_match)
        yield benchmark.sparkSession.sparkContext.broadcast(windows), [r.item for r in rows]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    min_match: int = MIN_MATCH,
    threshold: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs of a document and an item whose words it covers to at least ``threshold``.

    Columns: ``key``, ``item_key``, ``item_words``, ``covered_words``, ``coverage`` and
    ``tiles``, the matched word runs.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.lower(F.col(f"`{text}`").cast("string")).alias("text"))
    kind = benchmark.schema[item_key].dataType
    item_type = to_arrow_type(kind)
    fields = StructType.fromDDL(
        "item_words bigint, covered_words bigint, coverage double,"
        " tiles array<struct<item_word: int, document_word: int, words: int>>"
    ).fields
    schema = StructType([StructField("key", rows.schema["key"].dataType), StructField("item", kind), *fields])
    result = None
    for shared, ids in _item_blocks(benchmark, item_text, item_key, min_match, block_bytes):
        found = rows.mapInArrow(lambda b, s=shared, i=ids: _tiled(b, s, i, item_type, threshold), schema)
        result = found if result is None else result.unionAll(found)
    return result.select(F.col("key").alias(key), F.col("item").alias(item_key), *[f.name for f in fields])


def _clean(batches, items, threshold: float):
    for batch in batches:
        place = batch.num_columns - 1
        keep = np.ones(batch.num_rows, bool)
        keep[[row for row, *_ in _covering(batch.column(place), items.value, threshold)]] = False
        yield batch.select(range(place)).filter(pa.array(keep))


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_key: str = "item_id",
    min_match: int = MIN_MATCH,
    threshold: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns and without a shuffle."""
    schema = docs.schema
    for shared, _ in _item_blocks(benchmark, item_text, item_key, min_match, block_bytes):
        with_text = docs.select("*", F.lower(F.col(f"`{text}`").cast("string")).alias("_folded_text"))
        docs = with_text.mapInArrow(lambda b, s=shared: _clean(b, s, threshold), schema)
    return docs
