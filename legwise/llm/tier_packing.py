"""Packing documents into context windows of several lengths.

A document's ids end in the end-of-text id.  Whole windows of the longest tier are
cut off it, and the rest is routed to the shortest tier that holds it.  Tiers are
packed from the longest down: every rest opens a window of its tier, and the gap
behind it is filled from shorter tiers, with the longest rests that fit, the last
one cut to fit exactly.  The shortest tier is filled one after another.  Every
window is therefore full, except the one that a task ends with.  Windows of a tier
are dealt to step groups of one token budget, so all steps cost alike.

Packing needs no shuffle: each task packs the rows it reads, batch by batch, and
carries less than one window from a batch to the next.

Defined results: a null or empty text is a document of the end-of-text id alone;
repeated rows are packed one by one; other input columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from legwise.llm.pretokens import definition, encoder

TIERS = (256, 512, 1024, 2048)
END_OF_TEXT = 1
#: Tokens of a step group.
STEP_TOKENS = 32_768
#: Ids packed together; a batch of texts is packed in such parts.
PART_TOKENS = 1 << 21


class Span(NamedTuple):
    """A run of one document's ids that is still to be placed, shortest first."""

    length: int
    number: int  # of the span, so that equal lengths keep their order
    document: int
    start: int


class Piece(NamedTuple):
    document: int
    start: int
    length: int
    sequence: int
    offset: int
    tier: int


class Packer:
    """Places spans of one task; sequences are numbered in the order they are opened."""

    def __init__(self, tiers: Sequence[int] = TIERS):
        self.tiers = sorted(tiers)
        self.sequences, self.spans = count(), count()

    def _window(self, tier: int, spans: list[Span]) -> Iterator[Piece]:
        sequence, offset = next(self.sequences), 0
        for span in spans:
            yield Piece(span.document, span.start, span.length, sequence, offset, tier)
            offset += span.length

    def _take(self, pool: list[Span], room: int) -> Span:
        """The longest span that fits, else the head of the shortest one."""
        at = bisect_right(pool, (room, float("inf")))
        if at:
            return pool.pop(at - 1)
        span = pool.pop(0)
        insort(pool, Span(span.length - room, next(self.spans), span.document, span.start + room))
        return span._replace(length=room)

    def pack(self, rests: list[Span], last: bool) -> tuple[list[Piece], list[Span]]:
        """Pieces in full windows, and the spans left over (fewer ids than the shortest tier's window needs).

        With ``last`` the leftover fills a window of the longest tier that stays open.
        """
        pool, pieces = sorted(rests), []
        for tier, below in zip(self.tiers[::-1], [*self.tiers[-2::-1], 0]):
            while pool and pool[-1].length > below:
                if _sum_less(pool, tier):
                    break  # even all of them do not fill a window of this tier
                first = pool.pop()
                if first.length > tier:  # left over from a longer tier
                    insort(pool, Span(first.length - tier, next(self.spans), first.document, first.start + tier))
                    first = first._replace(length=tier)
                spans, room = [first], tier - first.length
                while room:
                    spans.append(self._take(pool, room))
                    room -= spans[-1].length
                pieces += self._window(tier, spans)
        if pool and last:
            pieces += self._window(self.tiers[-1], pool)
            pool = []
        return pieces, pool


def _sum_less(pool: list[Span], tier: int) -> bool:
    total = 0
    for span in reversed(pool):
        total += span.length
        if total >= tier:
            return False
    return True


def _packed(batches, tokenizer, end: int, tiers: Sequence[int], step_tokens: int):
    code = encoder(tokenizer.value)
    packer, longest = Packer(tiers), max(tiers)
    high = TaskContext.get().partitionId() << 36
    dealt = dict.fromkeys(tiers, 0)  # windows of each tier so far
    held: list[tuple[object, bytes]] = []  # key and ids of the documents with unplaced spans
    rests: list[Span] = []
    tail = np.array([end], "<u4").tobytes()
    kind = pa.null()

    def flush(whole: list[Piece], last: bool):
        nonlocal rests, held
        pieces, rests = packer.pack(rests, last)
        pieces = whole + pieces
        groups, windows = [], {}
        for piece in pieces:
            if piece.sequence not in windows:
                step = dealt[piece.tier] * piece.tier // step_tokens
                windows[piece.sequence] = high + (tiers.index(piece.tier) << 30) + step
                dealt[piece.tier] += 1
            groups.append(windows[piece.sequence])
        if pieces:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([held[p.document][0] for p in pieces], kind),
                    pa.array([p.start for p in pieces], pa.int64()),
                    pa.array([p.length for p in pieces], pa.int64()),
                    pa.array([held[p.document][1][4 * p.start : 4 * (p.start + p.length)] for p in pieces], pa.binary()),
                    pa.array([len(held[p.document][1]) // 4 for p in pieces], pa.int64()),
                    pa.array([high + p.sequence for p in pieces], pa.int64()),
                    pa.array([p.offset for p in pieces], pa.int64()),
                    pa.array([p.tier for p in pieces], pa.int32()),
                    pa.array(groups, pa.int64()),
                ],
                ["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"],
            )
        kept = sorted({span.document for span in rests})
        place = {document: k for k, document in enumerate(kept)}
        held = [held[document] for document in kept]
        rests = [span._replace(document=place[span.document]) for span in rests]

    for batch in batches:
        kind = batch.column(0).type
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        whole: list[Piece] = []
        pending = 0
        for key, text in zip(keys, texts):
            ids = code.ids(text or "") + tail
            held.append((key, ids))
            length, document = len(ids) // 4, len(held) - 1
            full = length // longest * longest
            for start in range(0, full, longest):
                whole += packer._window(longest, [Span(longest, 0, document, start)])
            if length > full:
                rests.append(Span(length - full, next(packer.spans), document, full))
            pending += length
            if pending >= PART_TOKENS:
                yield from flush(whole, False)
                whole, pending = [], 0
        if whole or rests:
            yield from flush(whole, False)
    if rests:
        yield from flush([], True)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    key: str = "doc_id",
    end: int = END_OF_TEXT,
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of a document: where its ``ids`` (little-endian, unsigned) come from and lie.

    ``sequence_id`` is the window, ``offset`` the place in it, ``tier`` the window's
    length and ``step_group`` its group of equal token budget and one tier.
    """
    tokenizer = docs.sparkSession.sparkContext.broadcast(definition(tokenizer_path))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    fields = StructType.fromDDL(
        "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint,"
        " tier int, step_group bigint"
    ).fields
    schema = StructType([StructField("key", rows.schema["key"].dataType), *fields])
    packed = rows.mapInArrow(lambda batches: _packed(batches, tokenizer, end, tiers, step_tokens), schema)
    return packed.select(F.col("key").alias(key), *[f.name for f in fields])
