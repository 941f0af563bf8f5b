"""Packing of tokenised documents into sequences, by Karmarkar-Karp multiway differencing.

Each task encodes its documents and packs them in blocks of about `BLOCK_SEQUENCES` sequences, so nothing is shuffled and memory
is bounded by a block and one document. Of a document longer than a sequence all full sequences go out as they are; the rest
is cut into pieces of at most `PIECE` ids. Differencing starts with each piece as a partition of its own, (size, 0, ..., 0), and
merges the two partitions with the largest spreads, heavy windows of one onto light windows of the other, until one is left with
nearly equal windows. There are as few windows as the total needs; while one exceeds the capacity, their number rises by one.

A sequence id is made of the task's partition number and a counter in it.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .stretches import byte_level

CAPACITY = 2048
END_ID = 1
BLOCK_SEQUENCES = 256
PIECE = 512
TOKENIZER = "byte_bpe_50k.json"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: a blank that has white space beside it, or begins or ends the text: no safe place to cut
UNSAFE = re.compile(r"\s |\A | \s| \Z")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where this machine keeps a public tokenizer's vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, as little-endian 32-bit numbers.

    As in `tokenizers`, a special token's text is encoded like any other with `encode_special_tokens` and is that token without
    it (the default there). Texts are cut at such tokens first; what lies between two of them is encoded as a text of its own.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        self.level = byte_level(path)
        self.added = added_tokens(path, encode_special_tokens)
        # the longest first: of tokens that begin alike the longest is meant
        self.marks = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True))) if self.added else None

    def stretches(self, text: str) -> list[str]:
        """The text cut before each single blank between two characters that are no white space, where no pre-token goes on; the blanks
        themselves are left out."""
        parts = text.split(" ")
        if not UNSAFE.search(text):
            return parts
        out = [parts[0]]
        for part in parts[1:]:
            if part and not part[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(part)
            else:
                out[-1] += " " + part
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return [self.bytes(t) for t in texts]

    def bytes(self, text: str) -> bytes:
        if self.marks is None or not self.marks.search(text):
            return self.level.encode(text).tobytes()
        parts, at = [], 0
        for found in self.marks.finditer(text):
            parts += [self.level.encode(text[at : found.start()]).tobytes(), np.array([self.added[found[0]]], np.uint32).tobytes()]
            at = found.end()
        return b"".join([*parts, self.level.encode(text[at:]).tobytes()])


@lru_cache(maxsize=1)
def encoder(path: str, encode_special_tokens: bool = True) -> Encoder:
    """One encoder for all tasks of a worker process."""
    return Encoder(path, encode_special_tokens)


def added_tokens(path: str, encode_special_tokens: bool) -> dict[str, int]:
    """The tokens of a tokenizer file that are cut out of texts before they are encoded, with their ids."""
    with open(path, encoding="utf-8") as f:
        made = [t for t in json.load(f)["added_tokens"] if t["content"] and not (encode_special_tokens and t["special"])]
    for t in made:
        # a stretch or a leaf of an edit tree may end at a blank, and no context of a token is looked at
        if re.search(r"\s", t["content"]) or t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"can't read the added token {t['content']!r}: it has white space or looks at its context")
    return {t["content"]: t["id"] for t in made}


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of sizes in each of `windows` groups with nearly equal sums."""
    heap = [(-size, i, np.array([size]), [i]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, in_a = heapq.heappop(heap)
        _, _, b, in_b = heapq.heappop(heap)
        if len(a) < len(b):
            a, in_a, b, in_b = b, in_b, a, in_a
        b, in_b = b[::-1], in_b[::-1]  # ascending; both have zeros beside what is stored
        alone = min(windows - len(b), len(a))
        both = len(a) - alone
        sums = np.concatenate([a[:alone], a[alone:] + b[:both], b[both:]])
        groups = in_a[:alone] + list(zip(in_a[alone:], in_b[:both], strict=True)) + in_b[both:]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        heapq.heappush(heap, (-spread, number, sums, [groups[i] for i in order]))
        number += 1
    out = []
    for group in heap[0][3] if heap else []:
        flat, stack = [], [group]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                flat.append(x)
        out.append(sorted(flat))
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Groups of pieces, none above the capacity, in as few windows as differencing manages."""
    count = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = difference(sizes, count)
        if all(sum(sizes[i] for i in g) <= capacity for g in groups):
            return groups
        count += 1


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, piece: int = PIECE, block: int = BLOCK_SEQUENCES, encode_special_tokens: bool = True) -> DataFrame:
    """Rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset), a piece each; ids are little-endian 32-bit.

    Every row of docs (doc_id, text) is encoded whole and ended with `end_id`; null and empty texts consist of that id. Each id is in exactly
    one piece; the pieces of a sequence lie without gaps from offset 0 and have `capacity` ids at most. Rows that repeat or
    have a null doc_id are packed like others. Other columns are ignored. `encode_special_tokens`: see `Encoder`.
    """
    def run(batches):
        encoded = encoder(path or tokenizer_path(), encode_special_tokens).batch
        base, sequence = TaskContext.get().partitionId() << 32, 0
        end = np.array([end_id], np.uint32).tobytes()
        waiting, size = [], 0

        def batch(rows):
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def flush(waiting):
            nonlocal sequence
            rows = []
            for group in windows_of([len(w[2]) // 4 for w in waiting], capacity):
                offset = 0
                for i in group:
                    doc, start, ids, total = waiting[i]
                    rows.append((doc, start, len(ids) // 4, ids, total, base + sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            return batch(rows)

        for table in batches:
            for part, _, _ in spans.chunks(table, "text"):
                rows = []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), encoded(texts), strict=True):
                    ids += end
                    total = len(ids) // 4
                    full = total // capacity
                    for k in range(full):
                        rows.append((doc, k * capacity, capacity, ids[k * capacity * 4 : (k + 1) * capacity * 4], total, base + sequence, 0))
                        sequence += 1
                    for start in range(full * capacity, total, piece):
                        waiting.append((doc, start, ids[start * 4 : (start + piece) * 4], total))
                    size += total - full * capacity
                    if size >= block * capacity:
                        yield flush(waiting)
                        waiting, size = [], 0
                if rows:
                    yield batch(rows)
        if waiting:
            yield flush(waiting)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
