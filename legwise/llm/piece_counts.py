"""Token counts by distinct pre-tokens, without any document's ids.

1. One pass over the texts splits them into pre-tokens.  Those that are themselves a
   piece of the vocabulary count one piece each at once, and so do those in many of a
   block's documents, by their pieces.  For each other pre-token of a block one row has
   the documents it occurs in and how often.
2. These rows are dealt and sorted by pre-token.  The library counts the pieces of each
   distinct pre-token once, its rows are multiplied by the count, and each task adds up
   what it has per document before the sums are shuffled.

No pre-token sends the postings of more than a ``1 / FREQUENT_PART`` of the documents,
so none is too much for one task.

Defined results: a null or empty text has 0 bytes and 0 tokens; every input row
gives one output row, repeated rows included; other input columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from legwise.llm.pretokens import definition, encoder

#: Documents and bytes of text in a block of postings; a document's place in its block fits 16 bits.
BLOCK_ROWS, BLOCK_BYTES = 1 << 16, 32 << 20
#: A pre-token in more than this part of a block's documents is counted where it is.
FREQUENT_PART, FREQUENT_LEAST = 16, 64
#: Blocks whose sums a task holds before it passes them on.
OPEN_BLOCKS = 64


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        if k > first and (size + len(text) > BLOCK_BYTES or k - first >= BLOCK_ROWS):
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def _postings(batches, tokenizer):
    code = encoder(tokenizer.value)
    single = code.single_pieces
    place = TaskContext.get().partitionId() << 33
    for batch in batches:
        keys, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        for first, last in _blocks(texts):
            number: dict[str, int] = defaultdict(count().__next__)
            for piece in single:
                number[piece]
            known, seen = np.zeros(last - first, np.int64), []
            for k in range(first, last):
                for pieces in code.pretokens(texts[k]):
                    ids = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
                    rare = ids[ids >= len(single)]
                    known[k - first] += len(ids) - len(rare)
                    seen.append(rare * BLOCK_ROWS + (k - first))
            sizes = [len(t.encode()) for t in texts[first:last]]
            codes, times = np.unique(np.concatenate(seen or [np.zeros(0, np.int64)]), return_counts=True)
            words = list(number)
            kinds, begins = np.unique(codes // BLOCK_ROWS, return_index=True)
            spans = np.diff(np.append(begins, len(codes)))
            frequent = np.flatnonzero(spans > max(FREQUENT_LEAST, (last - first) // FREQUENT_PART))
            if len(frequent):
                each = np.array(code.counts([words[p] for p in kinds[frequent]]))
                mine = np.isin(codes // BLOCK_ROWS, kinds[frequent])
                weights = np.repeat(each, spans[frequent]) * times[mine]
                known += np.bincount(codes[mine] % BLOCK_ROWS, weights, last - first).astype(np.int64)
                codes, times = codes[~mine], times[~mine]
            whole = pa.RecordBatch.from_arrays(
                [keys.slice(first, last - first), pa.array(sizes, pa.int64()), pa.array(known)], ["key", "n_bytes", "known"]
            )
            yield _frame(pa.nulls(1, pa.string()), pa.array([place]), pa.array([_packed(whole)], pa.binary()))
            while len(over := np.flatnonzero(times > 0xFFFF)):  # a count too large for its 16 bits is written in parts
                codes = np.concatenate([codes, codes[over]])
                times = np.concatenate([np.where(times > 0xFFFF, 0xFFFF, times), times[over] - 0xFFFF])
            order = np.argsort(codes, kind="stable")
            codes, times = codes[order], times[order]
            kinds, begins = np.unique(codes // BLOCK_ROWS, return_index=True)
            packed = ((codes % BLOCK_ROWS) << 16 | times).astype("<u4")
            bounds = np.append(begins, len(codes))
            binary = pa.Array.from_buffers(
                pa.binary(), len(kinds),
                [None, pa.py_buffer((bounds * 4).astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())],
            )
            pieces = pa.array([words[p] for p in kinds], pa.string())
            order = pc.array_sort_indices(pieces)  # like pieces together, for the shuffle's compression
            for at in range(0, len(kinds), 50_000):
                part = order.slice(at, 50_000)
                yield _frame(pieces.take(part), pa.array(np.full(len(part), place)), binary.take(part))
            place += last - first


def _packed(batch: pa.RecordBatch) -> bytes:
    """A block's documents as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _frame(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), ["piece", "block", "payload"])


def _sums(batches, tokenizer):
    """Rows sorted by pre-token: blocks of documents pass, postings become sums per document.

    A block's sums are one row of (place in the block, sum); a bounded number of blocks is held at a time.
    """
    code = encoder(tokenizer.value)
    held: dict[int, np.ndarray] = {}
    last, last_count = None, 0

    def frame(blocks, documents, payload):
        return pa.RecordBatch.from_arrays([blocks, documents, payload], ["block", "documents", "payload"])

    def flush():
        places = [np.flatnonzero(sums) for sums in held.values()]
        blobs = [(at.astype("<u8") << 48 | sums[at].astype("<u8")).tobytes() for at, sums in zip(places, held.values())]
        yield frame(pa.array(list(held), pa.int64()), pa.array([False] * len(blobs), pa.bool_()), pa.array(blobs, pa.binary()))
        held.clear()

    for batch in batches:
        documents = batch.filter(pc.is_null(batch.column(0)))
        if documents.num_rows:
            yield frame(documents.column(1), pa.array([True] * documents.num_rows), documents.column(2))
        postings = batch.filter(pc.is_valid(batch.column(0)))
        if not postings.num_rows:
            continue
        pieces = postings.column(0).to_pylist()
        kinds = [p for p, before in zip(pieces, [last, *pieces]) if p != before]
        counts = ([last_count] if pieces[0] == last else []) + [len(ids) for ids in code.encode(kinds)]
        changes = np.array([p != before for p, before in zip(pieces[1:], pieces)], bool)
        each = np.array(counts)[np.concatenate([[0], np.cumsum(changes)])]
        last, last_count = pieces[-1], counts[-1]
        bases, blobs = postings.column(1).to_numpy(), postings.column(2).to_pylist()
        for base in np.unique(bases):
            mine = np.flatnonzero(bases == base)
            entries = np.frombuffer(b"".join([blobs[k] for k in mine]), "<u4")
            times = np.repeat(each[mine], [len(blobs[k]) // 4 for k in mine])
            gives = np.bincount(entries >> 16, weights=(entries & 0xFFFF) * times, minlength=BLOCK_ROWS)
            if base not in held and len(held) >= OPEN_BLOCKS:
                yield from flush()
            held[int(base)] = held.get(int(base), 0) + gives
    yield from flush()


def _documents(batches):
    """Rows sorted by block: each block's documents with all their sums."""
    block, total, documents = None, None, None

    def frame():
        keys, n_bytes, known = documents
        tokens = known.to_numpy() + total[: len(known)]
        return pa.RecordBatch.from_arrays([keys, n_bytes, pa.array(tokens)], ["key", "n_bytes", "n_tokens"])

    for batch in batches:
        for mine, whole, payload in zip(*[column.to_pylist() for column in batch.columns]):
            if mine != block:
                if documents is not None:
                    yield frame()
                block, total, documents = mine, np.zeros(BLOCK_ROWS, np.int64), None
            if whole:
                documents = pa.ipc.open_stream(payload).read_next_batch().columns
            else:
                entries = np.frombuffer(payload, "<u8")
                total[(entries >> 48).astype(np.int64)] += (entries & 0xFFFFFFFFFFFF).astype(np.int64)
    if documents is not None:
        yield frame()


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", limit: int = 512) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row."""
    spark = docs.sparkSession
    tokenizer = spark.sparkContext.broadcast(definition(tokenizer_path))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["key"].dataType
    place = F.when(F.col("piece").isNull(), F.xxhash64("block")).otherwise(F.xxhash64("piece"))
    sums = (
        rows.mapInArrow(lambda batches: _postings(batches, tokenizer), "piece string, block bigint, payload binary")
        .repartition(place)
        .sortWithinPartitions("piece")
        .mapInArrow(lambda batches: _sums(batches, tokenizer), "block bigint, documents boolean, payload binary")
    )
    counted = sums.repartition("block").sortWithinPartitions("block").mapInArrow(
        _documents,
        StructType([StructField("key", kind), *StructType.fromDDL("n_bytes bigint, n_tokens bigint").fields]),
    )
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
