"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words and word beginnings is trained in numpy from
confirmed toxic texts and unlabelled ones.  The unlabelled texts hold a share of
toxic ones, the class prior, so their risk as clean texts is corrected by the toxic
texts' own; where the corrected risk falls below zero the step goes back up it
(non-negative risk estimator), which keeps the classifier from learning the
unlabelled texts by heart.  Only features much more frequent in the toxic texts than
in the unlabelled ones take part.

Training reads a bounded sample (``POSITIVES`` and ``UNLABELLED`` texts, chosen by a
hash of the id); scoring reads every whole text, next to the scan, with the weights
broadcast (a table of bounded size).

Defined results: a null or empty text scores as a text without any feature, near the
lowest score; without toxic examples every score is the prior; repeated rows score
alike; rows without an id are scored, not learnt from; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from legwise.llm.string_tiling import LETTERS_ONLY
from legwise.llm.texts import blocks, lowered, mix, prefix_hash, span_hash, word_spans

POSITIVES, UNLABELLED = 4000, 10_000
FEATURE_BITS = 18
#: Bytes of the word beginnings that are features beside the whole word.
BEGINNINGS = (4, 6)
#: Least z-score and log ratio of a feature's frequency in toxic over unlabelled texts, and toxic texts that have it.
LEAST_Z, LEAST_LOG_RATIO, LEAST_TEXTS = 4.0, 0.7, 3
THRESHOLD = 0.7


class Model(NamedTuple):
    places: np.ndarray  # of a feature among the weights, -1 if it has none
    weights: np.ndarray
    bias: float


def features(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct features of every text."""
    found = []
    for block in blocks(column):
        data = lowered(block.data)
        starts, ends, bounds = word_spans(data, block.offsets, LETTERS_ONLY)
        running = prefix_hash(data)
        hashes = [span_hash(running, starts, ends)]
        for size in BEGINNINGS:
            hashes.append(mix(span_hash(running, starts, np.minimum(starts + size, ends)) + np.uint64(size)))
        numbers = np.stack([(h >> np.uint64(64 - FEATURE_BITS)).astype(np.int32) for h in hashes], axis=1)
        found += [np.unique(numbers[bounds[k] : bounds[k + 1]]) for k in range(len(bounds) - 1)]
    return found


def _feature_rows(batches):
    for batch in batches:
        found = features(batch.column(1))
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["positive", "features"])


class Sparse(NamedTuple):
    """Which weights each text has."""

    texts: np.ndarray
    weights: np.ndarray
    count: int

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.texts, weights=weights[self.weights], minlength=self.count)

    def spread(self, values: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.weights, weights=values[self.texts], minlength=size)


def _sparse(rows: list[np.ndarray], places: np.ndarray) -> Sparse:
    found = [places[row][places[row] >= 0] for row in rows]
    texts = np.repeat(np.arange(len(rows)), [len(f) for f in found])
    return Sparse(texts, np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64), len(rows))


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))


def choose(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Places of the features that mark toxic texts."""
    size = 1 << FEATURE_BITS
    in_positive = np.bincount(np.concatenate([np.zeros(0, np.int64), *positive]), minlength=size)
    in_unlabelled = np.bincount(np.concatenate([np.zeros(0, np.int64), *unlabelled]), minlength=size)
    p, u = (in_positive + 0.1) / (len(positive) + 0.2), (in_unlabelled + 0.1) / (len(unlabelled) + 0.2)
    z = (p - u) / np.sqrt(p * (1 - p) / max(1, len(positive)) + u * (1 - u) / max(1, len(unlabelled)))
    wanted = np.flatnonzero((z > LEAST_Z) & (np.log(p / u) > LEAST_LOG_RATIO) & (in_positive >= LEAST_TEXTS))
    places = np.full(size, -1, np.int32)
    places[wanted] = np.arange(len(wanted))
    return places


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
    steps: int = 300, rate: float = 0.1, decay: float = 1e-4, beta: float = 0.0,
) -> Model:
    """Logistic loss, the non-negative risk estimator, full-batch Adam."""
    places = choose(positive, unlabelled)
    size = int(places.max(initial=-1)) + 1
    weights, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    if not size:
        return Model(places, weights, bias)
    toxic, mixed = _sparse(positive, places), _sparse(unlabelled, places)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        of_toxic, of_mixed = toxic.sums(weights) + bias, mixed.sums(weights) + bias
        clean_risk = np.logaddexp(0, of_mixed).mean() - prior * np.logaddexp(0, of_toxic).mean()
        as_clean_toxic = -prior * _sigmoid(of_toxic) / toxic.count
        as_clean_mixed = _sigmoid(of_mixed) / mixed.count
        if clean_risk >= -beta:
            grad_toxic, grad_mixed = as_clean_toxic - prior * _sigmoid(-of_toxic) / toxic.count, as_clean_mixed
        else:
            grad_toxic, grad_mixed = -as_clean_toxic, -as_clean_mixed
        gradient = np.append(
            toxic.spread(grad_toxic, size) + mixed.spread(grad_mixed, size) + decay * weights,
            grad_toxic.sum() + grad_mixed.sum(),
        )
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(places, weights, bias)


def _last_hash(wanted: int, total: int) -> int:
    """Last signed 64-bit hash of a range that holds about 1.2 times the wanted number of ``total`` rows."""
    if 6 * wanted >= 5 * total:
        return (1 << 63) - 1
    return -(1 << 63) + (6 * wanted << 64) // (5 * total)


def fit(
    docs: DataFrame, labels: DataFrame, learnt: Column, text: str = "text", key: str = "doc_id", label: str = "toxic",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> Model:
    """Train on rows where ``learnt`` (over ``key``) holds.

    The prior is the toxic share of the labelled rows; the unlabelled texts are drawn
    from all rows, whatever their label.
    """
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.where(F.col(key).isNotNull() & learnt)
    known = labels.select(F.col(f"`{key}`").alias(key), F.col(f"`{label}`").alias("label")).where(F.col("label").isNotNull() & learnt)
    seen, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("label") == 1).cast("bigint"))).first()
    if not toxic:
        return Model(np.full(1 << FEATURE_BITS, -1, np.int32), np.zeros(0), float(np.log(0.01)))
    draw = F.xxhash64(key, F.lit("draw"))
    # at most ``positives`` ids
    chosen = known.where("label = 1").select(key).distinct().orderBy(draw, key).limit(positives)
    # of a repeated id the text with the smallest hash
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    confirmed = rows.join(F.broadcast(chosen), key).groupBy(key).agg(one).orderBy(key).select(F.lit(True).alias("positive"), "text")
    total = rows.count()
    # a hash range that holds about the wanted number of rows
    drawn = rows.where(draw <= _last_hash(unlabelled, total)).orderBy(draw, key).select(F.lit(False).alias("positive"), "text")
    schema = "positive boolean, features array<int>"
    found = [
        frame.mapInArrow(_feature_rows, schema).toArrow()
        for frame in (confirmed, drawn.limit(unlabelled))
    ]
    toxic_rows, mixed_rows = ([r.values.to_numpy() for r in f.column("features")] for f in found)
    if total and not mixed_rows:
        raise ValueError(f"no unlabelled text was drawn from {total} rows; their ids may be few")
    prior = min(0.9, max(0.001, toxic / seen))
    return train(toxic_rows, mixed_rows, prior)


def _scores(batches, model):
    places, weights, bias = model.value
    for batch in batches:
        rows = _sparse(features(batch.column(1)), places)
        scores = _sigmoid((rows.sums(weights) if len(weights) else np.zeros(rows.count)) + bias)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["key", "score"])


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``score`` (0 to 1, higher is more likely toxic) and ``predicted`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([rows.schema["key"], *StructType.fromDDL("score double").fields])
    scored = rows.mapInArrow(lambda batches: _scores(batches, shared), schema)
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
