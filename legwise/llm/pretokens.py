"""Byte-level BPE: a text's pre-tokens, their pieces, and a text's ids.

Merges stay inside a pre-token, so a text's ids are the ids of its pre-tokens in
order.  Whole texts are encoded by a library that runs the definition's pieces and
merges several times faster than the tokenizer's own and gives the same ids.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import regex
import tiktoken

#: Fixed value: the published split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text split at once; a cut lies before a space between two words, where a pre-token begins.
SEGMENT = 1 << 20
#: Bytes with or without white space in a row from which a text is encoded by the tokenizer's own library,
#: whose time does not grow with the square of a run.
LONG_RUN = 4096

KNOWN_ENTRIES = 200_000

_SPLIT = regex.compile(PATTERN)
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def _byte_characters() -> dict[str, int]:
    """Byte-level BPE writes a printable Latin-1 byte as itself and the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


_BYTES = _byte_characters()


def _longest_run(text: str) -> int:
    gap = np.frombuffer(text.encode(), np.uint8) <= 32
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return int(np.diff(np.concatenate([[-1], edges, [len(gap) - 1]])).max())


class Encoder:
    def __init__(self, definition: str):
        parts = json.loads(definition)
        split = parts["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        added = parts.get("added_tokens", [])
        if not plain or parts.get("normalizer") or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("only plain byte-level BPE tokenizers are read pre-token by pre-token")
        self.definition = definition
        specials = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.parts = parts
        self.known: dict[str, int] = {}

    @cached_property
    def library(self):
        """The tokenizer's own library; built where it is used, since a worker that encodes whole texts hardly needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.definition)
        library.no_truncation()
        library.no_padding()
        return library

    def pretokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of ``text`` in order, a list for each segment; special strings stand alone."""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield [part]
                continue
            begin = 0
            while len(part) - begin > SEGMENT:
                cut = _CUT.search(part, begin + SEGMENT)
                if cut is None:
                    break
                yield _SPLIT.findall(part, begin, cut.start()) if begin else _SPLIT.findall(part[: cut.start()])
                begin = cut.start()
            if begin < len(part):
                yield _SPLIT.findall(part[begin:] if begin else part)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(pieces, add_special_tokens=False)]

    def counts(self, pieces: list[str]) -> list[int]:
        """Pieces of each pre-token; for pre-tokens asked for again and again."""
        missing = [p for p in pieces if p not in self.known]
        if len(self.known) > KNOWN_ENTRIES:
            self.known.clear()
            missing = pieces
        self.known.update(zip(missing, map(len, self.encode(missing))))
        return [self.known[p] for p in pieces]

    @cached_property
    def merges(self) -> tiktoken.Encoding:
        """The same pieces and merges in a faster library; its ranks are the order of the merges."""
        model, order = self.parts["model"], {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            order[left + right] = rank
        by_id = sorted((i, token) for token, i in model["vocab"].items() if token in order)
        if any(order[a[1]] > order[b[1]] for a, b in zip(by_id, by_id[1:])):
            raise ValueError("the vocabulary is not in the order of its merges")
        ranks = {bytes(_BYTES[c] for c in token): i for token, i in model["vocab"].items()}
        specials = {a["content"]: a["id"] for a in self.parts.get("added_tokens", [])}
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=specials)

    def ids(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if len(text) > LONG_RUN and _longest_run(text) > LONG_RUN:
            pieces = (ids for part in self.pretokens(text) for ids in self.encode(part))
            return b"".join(np.array(ids, "<u4").tobytes() for ids in pieces)
        return self.merges.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    @cached_property
    def single_pieces(self) -> list[str]:
        """Pre-tokens that are one piece of the vocabulary; a table of bounded size."""
        tokens = [self.library.decode([i]) for i in range(self.library.get_vocab_size())]
        whole = [t for t in tokens if "�" not in t and _SPLIT.findall(t) == [t]]
        return [t for t, ids in zip(whole, self.encode(whole)) if len(ids) == 1]


@lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    """One encoder for each Python worker and tokenizer."""
    return Encoder(definition)


def definition(path: str) -> str:
    """The tokenizer file's text, to be broadcast: executors need no file of their own."""
    with open(path, encoding="utf-8") as file:
        return file.read()
