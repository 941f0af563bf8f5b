"""Removal of word sequences that an earlier document already has, by groups of suffixes with a common prefix.

Every word position starts a suffix. Only nodes at the depth of a window (13 words) count, so suffixes are cut there; no tree is
stored, its nodes are groups of rows that Spark shuffles:

1. *Prefixes.* Of each window the least seed (6 words) is its prefix. Neighbouring windows mostly share theirs, so a
   prefix stands for a run of suffixes; equal windows have equal prefixes at equal places. Blocks of documents (6 MB)
   emit each prefix once, with its continuation (null if the block has several) and the smallest document: a passage that a
   third of all documents share makes one row a block, not one a document.
2. *One continuation.* Where a prefix always continues in the same way, the smallest document of that prefix answers for all its
   windows. A prefix seen in one block only is answered inside the block.
3. *Branching.* Where continuations differ the prefix is lengthened to the whole window: its windows become a group
   each, again one row a block, and get their own smallest document.
4. The answers go back to the blocks. A window with an answer below its document's id is a repeat; neighbouring ones make up
   the maximal repeats, whose words are removed.

A block's text is shuffled once and read three times (Spark reuses the exchange). A group has a row a block at most. With more
than `FAN` blocks a group is summed up by parts of `FAN` blocks first, then over its parts, and the sums are joined back part
by part, so no task holds more than `FAN` rows of a prefix in either step (up to FAN * FAN blocks, 100 TB). Sequences are compared by
64-bit hashes of words, seeds and continuations together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import spans
from .shared import BLOCK_BYTES, NO_ID, block_count, block_of

WINDOW = 13
SEED = 6
#: blocks whose rows of one prefix may meet in a task
FAN = 4096
FOUND = "block int, prefix long, rest long, least long"
RESULT = "n_words long, n_removed long, removed array<struct<first:long,last:long>>, kept string"


class Suffixes:
    """The windows of some texts by document, with the prefix and the continuation of their runs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, window: int, seed: int):
        self.words = spans.words(data, offsets, spans.NOT_SPACE)
        h = spans.hashes(data, self.words)
        row = self.words.row
        self.start = np.flatnonzero(spans.whole(row, window))
        self.doc = ids[row[self.start]]
        seeds = spans.grams(h, seed)
        least, shift = seeds[self.start], np.zeros(len(self.start), np.int64)
        for k in range(1, window - seed + 1):
            other = seeds[self.start + k]
            lower = other < least
            least, shift = np.where(lower, other, least), np.where(lower, k, shift)
        self.prefix = least
        n = len(self.start)
        new = np.ones(n, bool)
        if n:
            at = self.start + shift
            new[1:] = (at[1:] != at[:-1]) | (self.start[1:] != self.start[:-1] + 1)
        self.run = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        last = np.append(first[1:], n)[: len(first)] - 1
        a, b = self.start[first], self.start[last] + window
        rest = np.empty(len(first), np.uint64)
        i = 0
        while i < len(first):  # pieces keep the power tables short
            j = max(i + 1, int(np.searchsorted(b, a[i] + spans.SEGMENT_BYTES, "right")))
            rest[i:j] = spans.ranges(h[a[i] : b[j - 1]], a[i:j] - a[i], b[i:j] - a[i])
            i = j
        rest += (b - a).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + shift[first].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        self.first, self.run_prefix, self.run_rest, self.run_doc = first, least[first], spans.mix(rest), self.doc[first]
        self.h, self.window = h, window

    def prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct prefixes, a continuation of each, its smallest document, whether it has several continuations; each run's prefix."""
        order = np.lexsort((self.run_rest, self.run_prefix))
        prefix, rest = self.run_prefix[order], self.run_rest[order]
        head = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1])) if len(order) else np.zeros(0, np.int64)
        last = np.append(head[1:], len(order))[: len(head)] - 1
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(head)), last - head + 1)
        least = np.minimum.reduceat(self.run_doc[order], head) if len(head) else np.zeros(0, np.int64)
        return prefix[head], rest[head], least, rest[head] != rest[last], group

    def path(self, which: np.ndarray) -> np.ndarray:
        """Hash of all the words of the windows in `which`."""
        m = len(self.h) - self.window + 1
        return spans.grams(self.h, self.window)[self.start[which]] if m > 0 else np.zeros(0, np.uint64)


def least_by(keys: list[np.ndarray], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows grouped by keys: a row of each group with its smallest doc, the group of each row, the groups' smallest docs."""
    order = np.lexsort((doc, *keys))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    head = order[new]
    return head, group, doc[head]


def signed(x: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    return pa.array(x.view(np.int64), mask=null)


def _read(table, window: int, seed: int) -> Suffixes:
    spans.give_back()
    data, at = spans.column_bytes(table.column("text"))
    return Suffixes(data, at, spans.integers(table.column("doc_id"), NO_ID), window, seed)


def _found(block: int, prefix, rest, doc, several=None) -> pa.Table:
    return pa.table({"block": pa.array(np.full(len(doc), block, np.int32)), "prefix": signed(prefix), "rest": signed(rest, several), "least": pa.array(doc)})


def _block(*tables) -> int:
    return next(t.column("block")[0].as_py() for t in tables if t.num_rows)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the wanted keys and whether there is one; keys are unique."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return values[at], keys[at] == wanted


def _ints(table, name: str) -> np.ndarray:
    return spans.integers(table.column(name), NO_ID)


def over_blocks(found: DataFrame, keys: list[str], blocks: int, fan: int = FAN) -> DataFrame:
    """Rows of found (block, keys) whose keys are in several blocks, with least and branches (several continuations) over all of them."""
    parts = -(-blocks // fan)
    every = Window.partitionBy(*keys)
    sums = {"n": F.count("*"), "told": F.count("rest"), "least": F.min("least"), "low": F.min("rest"), "high": F.max("rest")}
    if parts == 1:
        told = found.select("block", *keys, *[x.over(every).alias(name) for name, x in sums.items()])
    else:
        rows = found.withColumn("part", F.pmod("block", F.lit(parts)))
        some = rows.groupBy(*keys, "part").agg(*[x.alias(name) for name, x in sums.items()])
        sums = {"n": F.sum("n"), "told": F.sum("told"), "least": F.min("least"), "low": F.min("low"), "high": F.max("high")}
        merged = some.select(*keys, "part", *[x.over(every).alias(name) for name, x in sums.items()]).filter("n > 1")
        told = rows.select("block", *keys, "part").join(merged, [*keys, "part"])
    return told.filter("n > 1").select("block", *keys, "least", (F.expr("told < n") | F.coalesce(F.expr("low <> high"), F.lit(False))).alias("branches"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, block_bytes: int = BLOCK_BYTES, fan: int = FAN) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, carried (a struct of all its columns but the text), n_words,
    n_removed, removed (ranges of word numbers, the last one included) and kept (the words left, joined by one space).

    A word goes if a window of `window` words over it also starts in a document with a smaller doc_id; windows are those of
    the input. Null and empty texts have no words. Rows with the same doc_id are one document: they don't remove from each
    other. A null doc_id counts as larger than any other. Other columns may have any name.
    """
    blocks = block_count(docs, size=block_bytes)
    text = docs.select(
        block_of("doc_id", blocks).alias("block"), F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("carried"),
    )
    schema = StructType([StructField("doc_id", LongType()), text.schema["carried"], *StructType.fromDDL(RESULT)])
    by_block = text.groupBy("block")

    def prefixes(table: pa.Table) -> pa.Table:
        s = _read(table, window, seed)
        prefix, rest, least, several, _ = s.prefixes()
        return _found(_block(table), prefix, rest, least, several)

    seen = over_blocks(by_block.applyInArrow(prefixes, FOUND), ["prefix"], blocks, fan)
    nodes = seen.select("block", "prefix", F.when(~F.col("branches"), F.col("least")).alias("least"))

    def branches(texts: pa.Table, below: pa.Table) -> pa.Table:
        wanted = below.filter(below.column("least").is_null())
        if not texts.num_rows or not wanted.num_rows:
            return _found(0, *[np.zeros(0, np.uint64)] * 2, np.zeros(0, np.int64))
        s = _read(texts, window, seed)
        _, hit = _lookup(_ints(wanted, "prefix"), np.zeros(wanted.num_rows, np.int64), s.prefix.view(np.int64))
        which = np.flatnonzero(hit)
        prefix, path, doc = s.prefix[which], s.path(which), s.doc[which]
        head, _, least = least_by([path, prefix], doc)
        return _found(_block(texts), prefix[head], path[head], least)

    deep = over_blocks(by_block.cogroup(nodes.groupBy("block")).applyInArrow(branches, FOUND), ["prefix", "rest"], blocks, fan)
    answers = nodes.select("block", "prefix", F.lit(None).cast("long").alias("rest"), "least", F.lit(False).alias("deep")).unionByName(deep.select("block", "prefix", "rest", "least", F.lit(True).alias("deep")))

    def cut(texts: pa.Table, told: pa.Table) -> pa.Table:
        s = _read(texts, window, seed)
        n = len(s.words.start)
        _, group, low = least_by([s.run_rest, s.run_prefix], s.run_doc)
        least = low[group][s.run] if len(s.run) else np.zeros(0, np.int64)
        deep_rows = told.column("deep").to_numpy() if told.num_rows else np.zeros(0, bool)
        top, bottom = told.filter(pa.array(~deep_rows)), told.filter(pa.array(deep_rows))
        open_ = top.column("least").is_null().to_numpy() if top.num_rows else np.zeros(0, bool)
        value, hit = _lookup(_ints(top, "prefix"), np.where(open_, -1, np.arange(len(open_))), s.prefix.view(np.int64))
        direct = hit & (value >= 0)
        least[direct] = np.minimum(least[direct], _ints(top, "least")[value[direct]])
        *_, several, of = s.prefixes()
        which = np.flatnonzero(hit & (value < 0) | several[of][s.run]) if len(hit) else np.zeros(0, np.int64)
        if len(which):
            path = s.path(which)
            _, group, low = least_by([path, s.prefix[which]], s.doc[which])
            own = low[group]
            key = spans.mix(path * spans.ROLL + s.prefix[which]).view(np.int64)
            keys = spans.mix(_ints(bottom, "rest").view(np.uint64) * spans.ROLL + _ints(bottom, "prefix").view(np.uint64)).view(np.int64)
            other, known = _lookup(keys, _ints(bottom, "least"), key)
            least[which] = np.where(known, np.minimum(own, other), own)
        later = s.start[least < s.doc]
        depth = np.zeros(n + 1, np.int64)
        np.add.at(depth, later, 1)
        np.add.at(depth, later + window, -1)
        gone = np.cumsum(depth[:-1]) > 0
        first, count = s.words.first, np.diff(s.words.first)
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(gone)])
        row = s.words.row
        opens = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (row[1:] != row[:-1])])) if n else np.zeros(0, np.int64)
        shuts = np.flatnonzero(gone & np.concatenate([~gone[1:] | (row[1:] != row[:-1]), [True]])) if n else np.zeros(0, np.int64)
        ranges = pa.StructArray.from_arrays([pa.array(opens - first[row[opens]]), pa.array(shuts - first[row[opens]])], ["first", "last"])
        data, at = spans.column_bytes(texts.column("text"))
        kept, kept_at = spans.join_words(data, s.words, ~gone)
        return pa.table({
            "doc_id": texts.column("doc_id"), "carried": texts.column("carried"), "n_words": pa.array(count), "n_removed": pa.array(total[first[1:]] - total[first[:-1]]),
            "removed": pa.ListArray.from_arrays(pa.array(np.searchsorted(opens, first).astype(np.int32)), ranges), "kept": spans.strings(kept, kept_at),
        })

    return by_block.cogroup(answers.groupBy("block")).applyInArrow(cut, schema)
