"""Language of a text by unigrams summed over all segmentations.

The vocabulary is the pieces of a public tokenizer that consist of small letters and
bytes beyond ASCII, some after a space.  A text is lower-cased and cut into words, runs of
such bytes, each with a space before it.  A language gives every piece a probability; a word's
probability is the sum, over all ways to write it as pieces, of the product of theirs.  The
forward algorithm computes it in one walk over the lattice of pieces, for all languages and
all distinct words of a block at once.  A text's score is the sum of the logarithms.

Learning counts the words of all labelled texts by language in one aggregation, whose size grows
with the corpus, and then takes ``PASSES`` passes of expectation and maximisation over the distinct
words: forward and backward sums give each piece's expected number of uses, summed by
Spark.  Only languages x pieces numbers reach the driver.  Each language is smoothed with the mean
of all.

A run longer than ``PART`` bytes, as in scripts without spaces, is cut every ``PART`` bytes; the
parts after the first have no space before them.  Pieces end at parts; nothing is left out.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
could be learnt; else the score is the probability of the predicted language among the learnt ones,
each as likely beforehand (ties: the first in order of names); texts without a language or a letter are not
learnt from; every row gives one row, repeated rows score alike; a null id is not learnt from where ``learnt`` needs
it; other columns are ignored.  More than ``LANGUAGES`` languages are an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from legwise.llm.texts import blocks, mix, prefix_hash, span_hash, word_spans
from legwise.staging import stage

#: Bytes of a word that are summed over together; a multiple of it is the block of text.
PART, BLOCK = 32, 1 << 20
PASSES = 2
#: Bytes of scored words that a task remembers.
KNOWN_BYTES = 24 << 20
#: Bound of the model: as many languages times the pieces, 8 bytes each, are broadcast.
LANGUAGES = 256
#: Uses of the mean distribution that are added to a language's own.
PRIOR_USES = 500.0
#: Least probability; 33 bytes of it are still a positive number.
LEAST = 1e-9
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_CLASS = np.zeros(256, np.uint8)  # 0 is the space
_CLASS[_LETTER] = np.arange(1, 1 + _LETTER.sum())
CLASSES = 1 + int(_LETTER.sum())


class Lattice(NamedTuple):
    """The vocabulary as a trie; node 0 is the root, which no step leads to."""

    step: np.ndarray  # node and class to node, 0 if there is none
    piece: np.ndarray  # number of the piece that ends at a node, or -1
    longest: int


class Model(NamedTuple):
    vocabulary: bytes
    languages: list[str]
    shares: np.ndarray  # pieces x languages


class Words(NamedTuple):
    """Distinct words, one after the other."""

    data: np.ndarray
    offsets: np.ndarray


def read_vocabulary(path: str) -> bytes:
    """Pieces of a rank file (base64 and rank per line) that words are made of, sorted, one a line."""
    with open(path, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file if line.strip()}
    pieces |= {bytes([b]) for b in (32, *np.flatnonzero(_LETTER))}  # so that every word can be written
    return b"\n".join(sorted(p for p in pieces if all(_LETTER[b] or (b == 32 and not k) for k, b in enumerate(p)) and 0 < len(p) <= PART))


@lru_cache(maxsize=2)
def lattice(vocabulary: bytes) -> Lattice:
    nodes: dict[tuple[int, int], int] = {}
    ends: list[int] = [-1]
    pieces = vocabulary.split(b"\n")
    for number, piece in enumerate(pieces):
        node = 0
        for byte in piece:
            edge = (node, int(_CLASS[byte]))
            node = nodes.get(edge, 0)
            if not node:
                node = nodes[edge] = len(ends)
                ends.append(-1)
        ends[node] = number
    step = np.zeros((len(ends), CLASSES), np.int32)
    edges = np.array(list(nodes), np.int64)
    step[edges[:, 0], edges[:, 1]] = list(nodes.values())
    return Lattice(step, np.array(ends, np.int32), max(map(len, pieces)))


def slices(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """First text, lower-cased bytes and text offsets of pieces of about ``limit`` bytes, and whether a run goes on from before."""
    for block in blocks(pc.utf8_lower(column), limit):
        low, size = 0, len(block.data)
        if size <= limit or len(block.offsets) > 2:
            yield block.first, block.data, block.offsets, False
            continue
        while low < size:
            high = min(low + limit, size)
            gaps = np.flatnonzero(~_LETTER[block.data[low:high]]) if high < size else np.zeros(0, int)
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            goes_on = low > 0 and bool(_LETTER[block.data[low - 1]])
            yield block.first, block.data[low:high], np.array([0, high - low]), goes_on
            low = high


def distinct_words(data: np.ndarray, offsets: np.ndarray, goes_on: bool, group: np.ndarray | None = None):
    """Distinct words (of each group of texts), for every occurrence its word and its text, a text of each word, and the words' hashes."""
    starts, ends, bounds = word_spans(data, offsets, ~_LETTER)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    counts = -(-(ends - starts) // PART)
    run = np.repeat(np.arange(len(starts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[run] + nth * PART
    end = np.minimum(begin + PART, ends[run])
    spaced = nth == 0
    if goes_on and len(begin) and begin[0] == 0:
        spaced[run == 0] = False
    text = text[run]
    hashes = span_hash(prefix_hash(data), begin, end) + spaced.astype(np.uint64)
    if group is not None:
        hashes = mix(hashes) + group[text].astype(np.uint64)
    hashes, sample, word = np.unique(hashes, return_index=True, return_inverse=True)
    begin, end, spaced = begin[sample], end[sample], spaced[sample]
    sizes = end - begin + spaced
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    source = np.repeat(begin - spaced, sizes) + place
    lead = (place == 0) & np.repeat(spaced, sizes)
    found = np.where(lead, 32, data[np.where(lead, 0, source)]) if len(source) else np.zeros(0)
    return Words(found.astype(np.uint8), bounds), word, text, text[sample], hashes


class Edges(NamedTuple):
    """Pieces found in words, in order of where in the word they begin."""

    source: np.ndarray  # slots: a byte's is its place plus the number of words before; each word has one more at its end
    target: np.ndarray
    piece: np.ndarray
    word: np.ndarray
    groups: np.ndarray  # bounds of the edges of one begin


def edges(words: Words, trie: Lattice) -> Edges:
    sizes = np.diff(words.offsets)
    count = len(words.data)
    classes = _CLASS[words.data]
    word = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(words.offsets[1:], sizes) - np.arange(count)
    at, node, found = np.arange(count), np.zeros(count, np.int32), []
    for k in range(trie.longest):
        live = left[at] > k
        at = at[live]
        node = trie.step[node[live], classes[at + k]]
        live = node > 0
        at, node = at[live], node[live]
        if not len(at):
            break
        piece = trie.piece[node]
        hit = piece >= 0
        found.append((at[hit], np.full(int(hit.sum()), k + 1), piece[hit]))
    if not found:
        none = np.zeros(0, np.int64)
        return Edges(none, none, none, none, np.zeros(1, np.int64))
    at, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    begin = (at - words.offsets[word[at]]).astype(np.uint8)
    order = np.argsort(begin, kind="stable")
    at, size, piece, begin = at[order], size[order], piece[order], begin[order]
    of = word[at]
    groups = np.searchsorted(begin, np.arange(int(begin[-1]) + 2))
    return Edges(at + of, at + of + size, piece, of, groups)


def forward(words: Words, found: Edges, shares: np.ndarray) -> np.ndarray:
    """Probability, up to each slot, of all segmentations; ``shares`` is a row per edge."""
    sizes = len(words.offsets) - 1
    sums = np.zeros((len(words.data) + sizes, shares.shape[1]))
    sums[words.offsets[:-1] + np.arange(sizes)] = 1
    for low, high in zip(found.groups[:-1], found.groups[1:], strict=True):
        # pieces that begin at one place of a word end at different ones: no target occurs twice
        target = found.target[low:high]
        sums[target] = sums.take(target, axis=0) + sums.take(found.source[low:high], axis=0) * shares[low:high]
    return sums


def backward(words: Words, found: Edges, shares: np.ndarray) -> np.ndarray:
    """Probability of all segmentations from each slot to the word's end."""
    sizes = len(words.offsets) - 1
    sums = np.zeros(len(words.data) + sizes)
    sums[words.offsets[1:] + np.arange(sizes)] = 1
    for low, high in zip(found.groups[-2::-1], found.groups[:0:-1], strict=True):
        source = found.source[low:high]
        slots, number = np.unique(source, return_inverse=True)
        sums[slots] = np.bincount(number, weights=sums[found.target[low:high]] * shares[low:high])
    return sums


def word_shares(words: Words, trie: Lattice, shares: np.ndarray) -> np.ndarray:
    """Probability of each word in each language."""
    found = edges(words, trie)
    sums = forward(words, found, shares.take(found.piece, axis=0))
    return sums[words.offsets[1:] + np.arange(len(words.offsets) - 1)]


def expected_uses(words: Words, trie: Lattice, shares: np.ndarray, language: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (rows) in each language when word k, of ``language[k]``, is seen ``uses[k]`` times."""
    found = edges(words, trie)
    own = shares[found.piece, language[found.word]]
    before = forward(words, found, own[:, None])[:, 0]
    after = backward(words, found, own)
    total = before[words.offsets[1:] + np.arange(len(uses))]
    weight = before[found.source] * own * after[found.target] / total[found.word] * uses[found.word]
    place = found.piece.astype(np.int64) * shares.shape[1] + language[found.word]
    return np.bincount(place, weights=weight, minlength=shares.size).reshape(shares.shape)


def _counted(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = pc.dictionary_encode(batch.column(0))
        language = names.indices.to_numpy()
        for first, data, offsets, goes_on in slices(batch.column(1), 2 * BLOCK):
            mine = language[first : first + len(offsets) - 1]
            words, word, _, sample, _ = distinct_words(data, offsets, goes_on, mine)
            texts = pa.Array.from_buffers(pa.binary(), len(words.offsets) - 1, [
                None, pa.py_buffer(words.offsets.astype(np.int32).tobytes()), pa.py_buffer(words.data.tobytes())])
            uses = np.bincount(word, minlength=len(texts))
            yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(mine[sample])), texts, pa.array(uses)], ["lang", "word", "uses"])


def _used(batches, model: Model) -> Iterator[pa.RecordBatch]:
    trie, total = lattice(model.vocabulary), np.zeros(model.shares.shape)
    names = pa.array(model.languages)
    for batch in batches:
        for part in (batch.slice(k, 1 << 16) for k in range(0, batch.num_rows, 1 << 16)):
            texts = part.column(1).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            language = pc.index_in(part.column(0), names).to_numpy()
            total += expected_uses(Words(data, offsets - offsets[0]), trie, model.shares, language, part.column(2).to_numpy())
    piece, language = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(piece.astype(np.int32)), pa.array(language.astype(np.int32)), pa.array(total[piece, language])], ["piece", "language", "uses"])


def smoothed(uses: np.ndarray) -> np.ndarray:
    """Probabilities of the pieces in each language from their uses, mixed with the mean over languages."""
    own = uses / np.maximum(uses.sum(axis=0), 1e-300)
    mean = own.mean(axis=1) + 1e-7
    mean /= mean.sum()
    shares = (uses + PRIOR_USES * mean[:, None]) / (uses.sum(axis=0) + PRIOR_USES)
    return np.maximum(shares, LEAST)


def fit(docs: DataFrame, learnt: Column, vocabulary: str, text: str = "text", language: str = "lang", passes: int = PASSES) -> Model | None:
    """Piece probabilities of every language of the rows of ``docs`` for which ``learnt`` holds; ``vocabulary`` is a rank file."""
    known = F.col(f"`{language}`").isNotNull() & F.col(f"`{text}`").cast("string").rlike(r"\p{L}") & learnt
    rows = docs.where(known).select(F.col(f"`{language}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, word binary, uses bigint")
    words = stage(counted.groupBy("lang", "word").agg(F.sum("uses").alias("uses")), "language_words")
    names = sorted(r.lang for r in words.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not names:
        return None
    pieces = read_vocabulary(vocabulary)
    count = pieces.count(b"\n") + 1
    model = Model(pieces, names, np.full((count, len(names)), 1 / count))
    for _ in range(passes):
        shared = docs.sparkSession.sparkContext.broadcast(model)
        used = words.mapInArrow(lambda batches, b=shared: _used(batches, b.value), "piece int, language int, uses double")
        found = used.groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toArrow()
        shared.unpersist()
        uses = np.zeros(model.shares.shape)
        uses[found.column("piece").to_numpy(), found.column("language").to_numpy()] = found.column("uses").to_numpy()
        model = model._replace(shares=smoothed(uses))
    return model


class Scorer:
    """Logarithms of words' probabilities; those of up to ``KNOWN_BYTES`` are kept for the next block."""

    def __init__(self, model: Model):
        self.model, self.trie = model, lattice(model.vocabulary)
        self.room = KNOWN_BYTES // (8 + 8 * len(model.languages))
        self.known, self.logs = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))

    def __call__(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """A row per word; ``hashes`` are sorted."""
        place = np.searchsorted(self.known, hashes)
        seen = np.zeros(len(hashes), bool)
        inside = place < len(self.known)
        seen[inside] = self.known[place[inside]] == hashes[inside]
        logs = np.zeros((len(hashes), len(self.model.languages)))
        logs[seen] = self.logs.take(place[seen], axis=0)
        new = np.flatnonzero(~seen)
        if len(new):
            logs[new] = np.log(word_shares(_chosen(words, new), self.trie, self.model.shares))
            if len(self.known) + len(new) > self.room:
                self.known, self.logs = self.known[:0], self.logs[:0]
            if len(new) <= self.room:
                at = np.searchsorted(self.known, hashes[new])
                self.known, self.logs = np.insert(self.known, at, hashes[new]), np.insert(self.logs, at, logs[new], axis=0)
        return logs


def _chosen(words: Words, chosen: np.ndarray) -> Words:
    sizes = np.diff(words.offsets)[chosen]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(bounds[-1]) + np.repeat(words.offsets[chosen] - bounds[:-1], sizes)
    return Words(words.data[source], bounds)


def log_shares(column: pa.Array, scorer: Scorer) -> np.ndarray:
    """Logarithm of each text's probability in each language, up to the number of words."""
    found = np.zeros((len(column), len(scorer.model.languages)))
    for first, data, offsets, goes_on in slices(column):
        words, word, text, _, hashes = distinct_words(data, offsets, goes_on)
        logs = scorer(words, hashes)
        for k in range(logs.shape[1]):
            found[first : first + len(offsets) - 1, k] += np.bincount(text, weights=logs[word, k], minlength=len(offsets) - 1)
    return found


def _predicted(batches, shared) -> Iterator[pa.RecordBatch]:
    scorer = None if shared is None else Scorer(shared.value)
    for batch in batches:
        has_letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        if scorer is None or not batch.num_rows:
            names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
        else:
            logs = log_shares(batch.column(1), scorer)
            best = logs.argmax(axis=1)
            scores = np.where(has_letter, 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
            names = np.where(has_letter, np.array(scorer.model.languages, object)[best], UNKNOWN)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["key", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (0 to 1) of every row."""
    given = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{key}`").alias("key"), given.alias("text"), F.coalesce(given.rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    shared = None if model is None else docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([rows.schema["key"], *StructType.fromDDL("lang_pred string, score double").fields])
    return rows.mapInArrow(lambda batches: _predicted(batches, shared), schema).withColumnRenamed("key", key)
