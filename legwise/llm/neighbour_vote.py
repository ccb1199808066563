"""Quality by nearest-neighbour voting in a latent-semantic space.

The terms of a text are what its writing looks like in any language: pairs and
triples of runs of one kind of character (small letters, capitals, digits, a mark
and how often it is repeated), hashed, and how much words and word pairs repeat.
Labelled texts, a bounded sample, give term weights, a truncated singular value
decomposition and their own vectors, which are broadcast (``LABELLED`` rows of
``DIMENSIONS`` numbers).  Every text is mapped into the same space; exact cosines to
all labelled vectors are computed block by block as matrix products, and the labels
of the nearest ones are averaged with their similarity as weight.

Defined results: a text without terms (null, empty, white space) has no neighbours
and scores the labelled share of good texts; without labels every score is 0.5;
repeated rows score alike; rows without an id are scored, not learnt from; other
input columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from legwise.llm.texts import Block, blocks, mix, window_hashes, words

LABELLED = 4000
DIMENSIONS = 48
NEIGHBOURS = 7
#: Power of a neighbour's similarity that is its weight.
SHARPNESS = 8
THRESHOLD = 0.3
SHAPES, REPEATS = 1024, 2
#: Texts of one matrix product.
PRODUCT_ROWS = 512


def _kinds() -> np.ndarray:
    """Kind of character of every byte: small letter, capital, digit, white space, line end, or the mark itself."""
    kinds = np.zeros(256, np.uint64)  # bytes of non-ASCII characters are as small letters
    kinds[65:91], kinds[48:58] = 1, 2
    kinds[:33], kinds[127] = 3, 3
    kinds[10] = 4
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    kinds[marks] = np.arange(5, 5 + len(marks))
    return kinds


_KINDS = _kinds()


class Space(NamedTuple):
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray  # of the labelled texts, of length one
    labels: np.ndarray
    share: float  # of good ones


def terms(block: Block) -> np.ndarray:
    """Weighted term counts of a block's texts."""
    count = len(block.offsets) - 1
    kinds = _KINDS[block.data]
    text = np.repeat(np.arange(count), np.diff(block.offsets))
    found = np.zeros((count, SHAPES))
    if len(kinds):
        begins = np.flatnonzero(np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (text[1:] != text[:-1])]))
        lengths = np.minimum(np.diff(np.append(begins, len(kinds))), 3)
        lengths[kinds[begins] == 0] = 1
        runs, of = mix(kinds[begins] * np.uint64(4) + lengths.astype(np.uint64)), text[begins]
        places = []
        for size in (2, 3):
            hashes = window_hashes(runs, size)
            if len(hashes):
                inside = of[: len(hashes)] == of[size - 1 :]
                places.append(of[: len(hashes)][inside] * SHAPES + (hashes[inside] % np.uint64(SHAPES)).astype(np.int64))
        if places:
            found = np.bincount(np.concatenate(places), minlength=count * SHAPES).reshape(count, SHAPES).astype(float)
    table = words(block)
    repeats = np.zeros((count, REPEATS))
    pairs = window_hashes(table.hashes, 2)
    for k in range(count):
        begin, end = table.bounds[k], table.bounds[k + 1]
        if end - begin > 1:
            mine = pairs[begin : end - 1]
            repeats[k, 0] = (table.hashes[begin : end - 1] == table.hashes[begin + 1 : end]).mean()
            repeats[k, 1] = 1 - len(np.unique(mine)) / len(mine)
    shares = found / (found.sum(axis=1, keepdims=True) + 1)
    return np.log1p(400 * np.hstack([shares, repeats]))


def _term_rows(batches):
    for batch in batches:
        for block in blocks(batch.column(1), rows=PRODUCT_ROWS):
            found = terms(block)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.float64()))
            labels = batch.column(0).slice(block.first, len(found))
            yield pa.RecordBatch.from_arrays([labels, lists], ["label", "terms"])


def fit(
    docs: DataFrame, labels: DataFrame, learnt: Column, text: str = "text", key: str = "doc_id", label: str = "quality",
    labelled: int = LABELLED,
) -> Space | None:
    """The space of at most ``labelled`` labelled texts where ``learnt`` (over ``key``) holds, chosen by a hash of the id."""
    known = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").cast("double").alias("label"))
    known = known.where(F.col(key).isNotNull() & F.col("label").isNotNull() & learnt)
    chosen = known.groupBy(key).agg(F.max("label").alias("label")).orderBy(F.xxhash64(key, F.lit("vote")), key).limit(labelled)
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    # at most ``labelled`` ids; of a repeated id the text with the smallest hash
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    sample = rows.join(F.broadcast(chosen), key).groupBy(key, "label").agg(one).orderBy(key).select("label", "text")
    found = sample.mapInArrow(_term_rows, "label double, terms array<double>").toArrow()
    if not found.num_rows:
        return None
    values = np.stack([r.values.to_numpy() for r in found.column("terms")])
    good = found.column("label").to_numpy()
    idf = np.log((1 + len(values)) / (1 + (values > 0).sum(axis=0))) + 0.2
    weighted = values * idf
    spread, axes = np.linalg.eigh(weighted.T @ weighted)  # right singular vectors, smallest first
    axes = axes[:, ::-1][:, :DIMENSIONS]
    return Space(idf, axes, _unit(weighted @ axes).astype(np.float32), good, float(good.mean()))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-12)


def vote(space: Space, block: Block, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores of a block's texts: the similarity-weighted mean label of their nearest labelled vectors."""
    similar = _unit(terms(block) * space.idf @ space.axes).astype(np.float32) @ space.vectors.T
    count = min(neighbours, similar.shape[1])
    nearest = np.argpartition(-similar, count - 1, axis=1)[:, :count]
    weights = np.maximum(np.take_along_axis(similar, nearest, axis=1), 0).astype(float) ** SHARPNESS
    total = weights.sum(axis=1)
    votes = (weights * space.labels[nearest]).sum(axis=1)
    return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), space.share), 0, 1)


def _votes(batches, space):
    for batch in batches:
        if space is None:
            scores = np.full(batch.num_rows, 0.5)
        else:
            found = [vote(space.value, block) for block in blocks(batch.column(1), rows=PRODUCT_ROWS)]
            scores = np.concatenate([np.zeros(0), *found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["key", "score"])


def score(docs: DataFrame, space: Space | None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``score`` (0 to 1, higher is more likely good) and ``predicted`` of every row."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    shared = None if space is None else docs.sparkSession.sparkContext.broadcast(space)
    schema = StructType([rows.schema["key"], *StructType.fromDDL("score double").fields])
    scored = rows.mapInArrow(lambda batches: _votes(batches, shared), schema)
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, space: Space | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their own columns."""
    schema = docs.schema
    shared = None if space is None else docs.sparkSession.sparkContext.broadcast(space)
    place = docs.columns.index(text)

    def kept(batches):
        for batch in batches:
            column = batch.column(place)
            if shared is None:
                yield batch
                continue
            found = [vote(shared.value, block) for block in blocks(column, rows=PRODUCT_ROWS)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0), *found]) >= threshold))

    return docs.mapInArrow(kept, schema)
