"""Texts cut into stretches that public subword vocabularies encode apart, and ids of the distinct ones.

A byte-level pre-token never goes on past a single blank between two characters that are no white space, and no piece of the other
vocabulary has a blank behind another character. So the ids of a text are those of its stretches in a row, and a stretch that occurs
many times in a chunk is encoded once. Cuts are found on bytes; where a neighbour may be white space beyond ASCII none is made, which
makes a stretch longer and changes no id.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLANK = 0x20
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: first bytes of white space beyond ASCII (and of much else)
MAY_BEGIN = WHITE.copy()
MAY_BEGIN[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: fixed value: how a byte-level tokenizer of this kind splits text before it merges
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: a run of white space that the pattern's look-ahead can't go back through on the library's stack
LONG = 100_000
LONG_RUN = re.compile(r"\s{%d,}" % LONG)


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches start, ended by the length of the data, and the index of each row's first one, ended by their number."""
    n = len(data)
    mark = np.zeros(n + 1, bool)
    if n > 2:
        before, two = data[1:-1], data[:-2]
        # the last two bytes of white space beyond ASCII
        wide = ((two == 0xC2) & ((before == 0x85) | (before == 0xA0))) | (((two == 0x80) | (two == 0x81) | (two == 0x9A)) & (before >= 0x80))
        np.logical_and(data[2:] == BLANK, ~(WHITE[before] | wide), out=mark[2:n])
        mark[2 : n - 1] &= ~MAY_BEGIN[data[3:]]
        mark[n - 1] = False
    mark[offsets] = True
    at = np.flatnonzero(mark)
    return at, np.searchsorted(at, offsets)


def distinct(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The distinct stretches, as bytes, and the number of each stretch among them."""
    found = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large binary or text column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], at - at[0]


def codec(path: str, pattern: str = PATTERN):
    """The byte-level vocabulary of a tokenizer file, read for an encoder that gives the same ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {chr(c): b for b, c in [*((b, b) for b in plain), *((b, 256 + i) for i, b in enumerate(rest))]}
    special = {t["content"] for t in made["added_tokens"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in made["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class ByteLevel:
    """Ids of a byte-level vocabulary, special tokens' texts being ordinary text."""

    def __init__(self, path: str):
        self.codec, self._path = codec(path), path
        self.entries = [self.codec.decode_single_token_bytes(i) for i in range(self.codec.max_token_value + 1)]
        self.length = np.array([len(e) for e in self.entries], np.int64)
        self._runs = None

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        long = LONG_RUN.search(text) if len(text) >= LONG else None
        if not long:
            return self.codec.encode_to_numpy(text)
        if self._runs is None:
            self._runs = codec(self._path, r"\s+")
        parts, left = [], 0
        while long:
            # the run is one piece but for its last character, which belongs to what follows if anything does
            end = long.end() if long.end() == len(text) else long.end() - 1
            parts += [self.codec.encode_to_numpy(text[left : long.start()]), self._runs.encode_to_numpy(text[long.start() : end])]
            left, long = end, LONG_RUN.search(text, long.end())
        return np.concatenate([*parts, self.codec.encode_to_numpy(text[left:])])

    def encode_each(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of stretches one after the other, and each one's place among them. Stretches that begin and end safely are encoded as one text."""
        data, at = buffers(words)
        start, end = at[:-1], at[1:]
        n = len(start)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        pad = np.concatenate([np.zeros(2, np.uint8), data, np.zeros(2, np.uint8)])
        first, second, last, other = pad[start + 2], pad[start + 3], pad[end + 1], pad[end]
        wide = ((other == 0xC2) & ((last == 0x85) | (last == 0xA0))) | (((other == 0x80) | (other == 0x81) | (other == 0x9A)) & (last >= 0x80))
        safe = (end - start > 1) & (first == BLANK) & ~MAY_BEGIN[second] & ~WHITE[last] & ~wide & (end - start < 10_000)
        size = np.zeros(n, np.int64)
        pieces: list[np.ndarray] = []
        keep = np.flatnonzero(safe)
        together = words.take(pa.array(keep))
        joined, place = buffers(together)
        ids = self.codec.encode_to_numpy(joined.tobytes().decode())
        border = np.searchsorted(np.cumsum(self.length[ids]), place[1:]) + 1
        size[keep] = np.diff(border, prepend=0)
        rest = np.flatnonzero(~safe)
        alone = [self.encode(w.decode()) for w in words.take(pa.array(rest)).to_pylist()]
        size[rest] = [len(a) for a in alone]
        place = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        out = np.empty(place[-1], np.uint32)
        # safe ones keep their order, so their ids fill the places of safe stretches in a row
        owner = np.repeat(safe, size)
        out[owner] = ids
        pieces = np.concatenate(alone) if alone else np.zeros(0, np.uint32)
        out[~owner] = pieces
        return out, place


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    """One vocabulary for all tasks of a worker process."""
    return ByteLevel(path)


def expand(values: np.ndarray, place: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the entries `which`, one after the other, and each one's place among them; entry e has values[place[e]:place[e + 1]]."""
    size = np.diff(place)[which]
    at = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    source = np.arange(at[-1]) + np.repeat(place[which] - at[:-1], size)
    return values[source], at
