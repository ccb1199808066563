"""Words and word windows of Arrow text columns as numpy arrays.

Texts are handled in blocks of about ``BLOCK_BYTES`` bytes, whole texts at a
time, so memory is bounded by the block or by the longest single text.  A word
is a run of bytes other than space and ``\\t\\n\\v\\f\\r``; none of these occurs
inside a multi-byte UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WINDOW = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                    0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], np.uint64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


class Block(NamedTuple):
    """Texts ``first`` to ``first + len(offsets) - 2`` of a column."""

    first: int
    data: np.ndarray  # bytes of the block
    offsets: np.ndarray  # of the texts in data


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text k: bounds[k] to bounds[k + 1]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES, rows: int = 1 << 14) -> Iterator[Block]:
    """The texts of a string column in order, ``rows`` in a block at most; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, first + rows, len(column))
        yield Block(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``size`` of each."""
    return _powers(max(BLOCK_BYTES * 2, 1 << max(0, int(size)).bit_length()))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: ``span_hash`` gives any span's hash from it."""
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=running[1:])
    return running


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans, equal for equal bytes."""
    inverse = powers(len(running))[1]
    value = (running[ends] - running[starts]) * inverse[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR):
    """Starts and ends of the words, and the bounds of each text's words."""
    gap = separator[data]
    before, after = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    before[1:], after[: len(data)] = gap, gap
    before[offsets] = True
    after[offsets] = True
    starts = np.flatnonzero(~gap & before[:-1])
    ends = np.flatnonzero(~gap & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(block: Block, lower: bool = True) -> Words:
    data = lowered(block.data) if lower else block.data
    starts, ends, bounds = word_spans(data, block.offsets)
    return Words(starts, ends, span_hash(prefix_hash(data), starts, ends), bounds)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words, wherever it begins; none if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total += hashes[j : j + count] * (_WINDOW[j % len(_WINDOW)] + np.uint64(2 * (j // len(_WINDOW))))
    return mix(total + np.uint64(size))


def shingles(table: Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct window hashes of each text.

    A text with fewer words than ``size`` has its whole word sequence as the only
    member; a text without words has none.
    """
    everywhere = window_hashes(table.hashes, size)
    for k in range(len(table.bounds) - 1):
        begin, end = int(table.bounds[k]), int(table.bounds[k + 1])
        if end - begin >= size:
            yield np.unique(everywhere[begin : end - size + 1])
        else:
            yield window_hashes(table.hashes[begin:end], max(1, end - begin))
