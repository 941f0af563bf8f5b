"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Texts are read as lower-cased words, items in blocks of about `ITEM_BLOCK` and `ITEM_BYTES` (each block is one pass over the
documents, and all that a pass broadcasts). For an item of L words the windows are all stretches of L words of a document. A
window's fingerprint is the 64-bit SimHash of its five-word shingles, from running sums over the document. The 64 bits are cut
into six blocks; a fingerprint within 23 bits of an item's differs by three bits at most in one block, so looking up each
block with up to three bits flipped finds every fingerprint within that radius. A weighted Jaccard similarity of 0.8 is 9.5
differing bits on average (deviation 2.9), so the radius is 4.7 deviations wide. It is too wide for the blocks alone to sort
much out (random pairs: 58 % share a block, 1.6 % are within the radius), so items that have too few shingles in the
document's stretch for any window are left out before. What is found is verified by the exact weighted similarity of the
shingles' counts. Pairs are arrays throughout.

A document shorter than an item is the one window for it, as long as the item's length lets the similarity be reached. It is
compared with all items of that length by counts of shared shingles, without fingerprints.

A window that has no shingle of an item in common with it has similarity 0, so fingerprints are made for windows over shared
shingles only; that leaves out nothing that verification would keep.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .shared import NO_ID

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 6
FLIPS = RADIUS // BLOCKS
ITEM_BLOCK = 20_000
ITEM_BYTES = 32 << 20
#: bounds what is looked up at once: windows times items of one length, windows times masks, shingles of pairs
LOOKED_UP = 1 << 22
WIDTHS = [11] * 4 + [10] * 2
LEAKS = "doc_id long, item_id long, n_windows long, first_word long, n_words long, hamming long, similarity double"


class Items(NamedTuple):
    """Benchmark items of one length in words: sorted distinct shingle hashes of each with counts (item k has those from first[k] to
    first[k + 1]) and fingerprints."""

    ids: np.ndarray
    first: np.ndarray
    shingles: np.ndarray
    counts: np.ndarray
    prints: np.ndarray

    def shared(self, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What each item has in common with shingles of these counts."""
        place = np.minimum(np.searchsorted(values, self.shingles), len(values) - 1)
        least = np.where(values[place] == self.shingles, np.minimum(counts[place], self.counts), 0)
        return np.add.reduceat(least, self.first[:-1])


def stretched(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then those of first[1], and so on."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def signs(shingles: np.ndarray) -> np.ndarray:
    """A row of 64 values +1 or -1 for each shingle, from its bits."""
    bits = np.unpackbits(spans.mix(shingles.copy()).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of rows of 64 sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint64).reshape(-1)


def block_values(prints: np.ndarray) -> list[np.ndarray]:
    out, shift = [], 0
    for width in WIDTHS:
        out.append(((prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    return out


@cache
def flipped(width: int) -> tuple[int, ...]:
    """Masks of up to FLIPS bits."""
    return tuple(sum(1 << b for b in bits) for k in range(FLIPS + 1) for bits in combinations(range(width), k))


def read_words(texts: pa.Array):
    data, at = spans.column_bytes(texts)
    low = spans.LOWER[data]
    found = spans.words(low, at, spans.WORDLIKE)
    return found, spans.hashes(low, found)


def whole_text(h: np.ndarray) -> np.ndarray:
    """The only shingle of a text shorter than a shingle."""
    one = np.array([len(h)], np.uint64)
    for x in h:
        one = one * spans.ROLL + x
    return spans.mix(one)


def prepare(ids: list[int], texts: list[str | None]) -> tuple[dict[int, Items], np.ndarray, np.ndarray]:
    """Items by length, and the sorted shingles with the lengths of the items that hold them."""
    found, h = read_words(pa.array(texts, pa.string()))
    by_length: dict[int, list] = {}
    for r in range(len(ids)):
        x = h[found.first[r] : found.first[r + 1]]
        if len(x) and ids[r] is not None:
            values, counts = np.unique(spans.grams(x, min(SHINGLE, len(x))), return_counts=True)
            by_length.setdefault(len(x), []).append((ids[r], values, counts))
    made, keys, lengths = {}, [], []
    for length, rows in by_length.items():
        prints = packed(np.stack([(signs(v) * c[:, None]).sum(0) for _, v, c in rows]))
        first = np.concatenate([[0], np.cumsum([len(r[1]) for r in rows])])
        made[length] = Items(np.array([r[0] for r in rows]), first, np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]), prints)
        own = np.unique(made[length].shingles)
        keys.append(own)
        lengths.append(np.full(len(own), length))
    if not keys:
        return made, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, lengths = np.concatenate(keys), np.concatenate(lengths)
    order = np.argsort(keys, kind="stable")
    return made, keys[order], lengths[order]


def within(prints: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (number of a print, number of an own one) within RADIUS bits, in order."""
    n, found = len(own), [np.zeros(0, np.int64)]
    for width, values, there in zip(WIDTHS, block_values(prints), block_values(own), strict=True):
        order = np.argsort(there, kind="stable")
        start = np.searchsorted(there[order], np.arange((1 << width) + 1))
        masks = np.array(flipped(width))
        step = max(1, LOOKED_UP // max(n, len(masks)))
        for i in range(0, len(prints) if n else 0, step):
            value = values[i : i + step, None] ^ masks
            w, m = np.nonzero(start[value + 1] > start[value])
            value = value[w, m]
            size = start[value + 1] - start[value]
            w, k = np.repeat(w + i, size), order[stretched(start[value], size)]
            near = np.bitwise_count(prints[w] ^ own[k]) <= RADIUS
            found.append(w[near] * n + k[near])
    return np.divmod(np.unique(np.concatenate(found)), max(n, 1))


def in_common(items: Items, grams: np.ndarray, count: int, at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How many shingles the windows of `count` shingles from `at` on share with items k, by pair."""
    values, number = np.unique(grams, return_inverse=True)
    width = len(grams) + 1
    places = np.sort(number * width + np.arange(len(grams)))
    size = items.first[k + 1] - items.first[k]
    ends, out, i = np.cumsum(size), np.zeros(len(k), np.int64), 0
    while i < len(k):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - size[i] + LOOKED_UP, "right")))
        each = stretched(items.first[k[i:j]], size[i:j])
        pair = np.repeat(np.arange(j - i), size[i:j])
        place = np.minimum(np.searchsorted(values, items.shingles[each]), len(values) - 1)
        same = np.flatnonzero(values[place] == items.shingles[each])
        each, pair, low = each[same], pair[same], place[same] * width + at[i:j][pair[same]]
        here = np.searchsorted(places, low + count) - np.searchsorted(places, low)
        out[i:j] = np.bincount(pair, np.minimum(here, items.counts[each]), j - i)
        i = j
    return out


def search(items: Items, h: np.ndarray, length: int, starts: np.ndarray, similarity: float):
    """Verified pairs of an item and a window of one document, by window: arrays of item numbers, window starts, differing bits,
    similarities."""
    n = min(SHINGLE, length)
    count = length - n + 1
    low, high = int(starts[0]), int(starts[-1]) + length
    grams = spans.grams(h[low:high], n)
    most = items.shared(*np.unique(grams, return_counts=True))
    able = np.flatnonzero(most / (2 * count - np.minimum(most, count)) >= similarity - 1e-12)
    if not len(able):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0)
    sums = np.zeros((len(grams) + 1, 64), np.int32)
    np.cumsum(signs(grams), axis=0, out=sums[1:])
    prints = packed(sums[starts - low + count] - sums[starts - low])
    w, k = within(prints, items.prints[able])
    k = able[k]
    least = in_common(items, grams, count, starts[w] - low, k)
    score = least / (2 * count - least)
    sure = score >= similarity - 1e-12
    w, k, score = w[sure], k[sure], score[sure]
    return k, starts[w], np.bitwise_count(prints[w] ^ items.prints[k]).astype(np.int64), score


def compare(items: Items, h: np.ndarray, length: int, similarity: float):
    """Verified (item, 0, differing bits, similarity) of items of `length` words with the whole of a shorter document."""
    n = min(SHINGLE, length)
    here, there = len(h) - n + 1, length - n + 1
    if here < similarity * there - 1e-9:  # not even if all of the document is in the item
        return
    values, counts = np.unique(spans.grams(h, n), return_counts=True)
    least = items.shared(values, counts)
    score = least / (here + there - least)
    near = np.flatnonzero(score >= similarity - 1e-12)
    if len(near):
        own = packed((signs(values) * counts[:, None]).sum(0)[None])[0]
        for k in near:
            yield int(items.ids[k]), 0, int(own ^ items.prints[k]).bit_count(), float(score[k])


def find(h: np.ndarray, hit: np.ndarray, lengths: np.ndarray, n_of: dict[int, Items], similarity: float) -> dict[int, list]:
    """Leaks in one document: item -> [windows, start of the best one, its words, its bits, its similarity]. hit: word positions of
    shared shingles, each with the length of an item that has it."""
    out: dict[int, list] = {}
    for length in np.unique(lengths):
        if length > len(h):
            for item, start, bits, score in compare(n_of[int(length)], h, int(length), similarity):
                # a repeated item is found each time and is one row; of equal windows the first stays
                old = out.setdefault(item, [0, start, len(h), bits, score])
                old[0] += 1
                if score > old[4]:
                    old[1:] = [start, len(h), bits, score]
            continue
        at, reach = hit[lengths == length], length - min(SHINGLE, length)
        mark = np.zeros(len(h) + 1, np.int64)
        np.add.at(mark, np.maximum(at - reach, 0), 1)
        np.add.at(mark, at + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark)[: len(h) - length + 1] > 0)
        if not len(starts):
            continue
        items = n_of[int(length)]
        at_once = max(int(length), LOOKED_UP // 256)  # a running sum has 256 bytes
        for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1):
            for i in range(0, len(stretch), at_once):
                found, at, bits, score = search(items, h, int(length), stretch[i : i + at_once], similarity)
                order = np.lexsort((at, -score, found))  # an item's best window first, of equal ones the first
                head = np.flatnonzero(np.diff(found[order], prepend=-1))
                times = np.diff(head, append=len(order))
                for j, windows in zip(order[head], times, strict=True):
                    item = int(items.ids[found[j]])
                    old = out.setdefault(item, [0, int(at[j]), int(length), int(bits[j]), float(score[j])])
                    old[0] += int(windows)
                    if score[j] > old[4]:
                        old[1:] = [int(at[j]), int(length), int(bits[j]), float(score[j])]
    return out


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (doc_id, item_id, n_windows, first_word, n_words, hamming, similarity): each item with a window of its own number of
    words in a document whose weighted similarity is at least `similarity`; first_word, hamming and similarity are of the best
    window, the first of equal ones.

    Null, empty and wordless texts and items match nothing; so do items with a null item_id. Items of fewer words than a
    shingle have one shingle, all their words. For a document shorter than an item its whole text is the only window (n_words is
    then the document's; hamming may be above the radius, as fingerprints don't choose there). Repeated items are found each;
    repeated documents give a row each. Other columns are ignored.
    """
    size = items.filter(F.col("item_id").cast("long").isNotNull()).agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // ITEM_BLOCK), -(-(size["bytes"] or 0) // ITEM_BYTES))
    parts = []
    for k in range(blocks):
        block = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("item_id IS NOT NULL").filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        parts.append(_pass(docs, [tuple(r) for r in block.collect()], similarity))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def _pass(docs: DataFrame, rows: list, similarity: float) -> DataFrame:
    made, keys, key_length = prepare([r[0] for r in rows], [r[1] for r in rows])
    shared = docs.sparkSession.sparkContext.broadcast((made, keys, key_length))

    def scan(batches):
        n_of, keys, key_length = shared.value
        table = np.zeros(1 << 20, bool)
        table[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        short = sorted({min(SHINGLE, x) for x in n_of})
        for batch in batches:
            for part, data, at in spans.chunks(batch, "text"):
                low = spans.LOWER[data]
                found = spans.words(low, at, spans.WORDLIKE)
                h, row = spans.hashes(low, found), found.row
                hits, lengths = [], []
                for n in short:
                    grams = spans.grams(h, n)
                    may = np.flatnonzero(table[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)] & spans.whole(row, n))
                    left, right = np.searchsorted(keys, grams[may]), np.searchsorted(keys, grams[may], "right")
                    times = right - left
                    where = np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    fits = np.minimum(SHINGLE, key_length[where]) == n
                    hits.append(np.repeat(may, times)[fits])
                    lengths.append(key_length[where][fits])
                hit, length = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hits, lengths))
                order = np.argsort(row[hit], kind="stable")
                hit, length = hit[order], length[order]
                ids = spans.integers(part.column("doc_id"), NO_ID)
                found_rows, of = [], row[hit]
                for r in np.unique(of):
                    i, j = np.searchsorted(of, [r, r + 1])
                    a, b = found.first[r], found.first[r + 1]
                    for item, x in find(h[a:b], hit[i:j] - a, length[i:j], n_of, similarity).items():
                        found_rows.append((None if ids[r] == NO_ID else int(ids[r]), item, *x))
                if found_rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.float64() if k == 6 else pa.int64()) for k, c in enumerate(zip(*found_rows, strict=True))],
                        names=["doc_id", "item_id", "n_windows", "first_word", "n_words", "hamming", "similarity"],
                    )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, LEAKS)
