"""Near-duplicate join on five-word shingles with MinHash banding of a fixed depth and exact verification.

1. Texts with equal shingle sets are one class; the join goes on between one text of each class (the smallest doc_id).
2. A class gets a MinHash signature for each of `TREES` bands. All have one depth, the largest up to `LONGEST` at which two texts
   of the sought similarity share a band with the target recall (`prefix_length`; it doesn't depend on the data). Texts equal
   in a band are candidates. This took the place of an LSH forest: there is no trie, and dense nodes aren't split by longer prefixes.
3. Nodes with two texts or more become edges to their smallest text, so no pairs are made; connected components of
   these edges gather what has to be compared.
4. A component's shingle sets meet in one task, or, from 1,024 texts or 4 million shingles on, each two of its parts meet in
   one: a product of incidence matrices gives all intersections, so each Jaccard similarity is exact and no pair leaves
   the task. Out come each text's number of links and a spanning forest of the links.
5. Components of those forests are the classes.

With trees=16 and prefixes of 4 values the recall of a pair at similarity 0.8 is 0.9998 before step 3, which joins many of
the pairs that were missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from sigloom.session import cut_lineage

from . import spans
from .shared import NO_ID, components

SHINGLE = 5
SIMILARITY = 0.8
TREES = 16
LONGEST = 12
RECALL = 0.9995
PART_TEXTS = 1024
PART_SHINGLES = 4_000_000

_RANDOM = np.random.default_rng(77)
FACTORS = _RANDOM.integers(1, 2**31, TREES * LONGEST, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _RANDOM.integers(0, 2**32, TREES * LONGEST, dtype=np.uint32)


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, longest: int = LONGEST) -> int:
    """Shortens prefixes until a pair of this similarity shares one in some tree with the target recall."""
    length = longest
    while length > 1 and 1 - (1 - similarity**length) ** trees < recall:
        length -= 1
    return length


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes of lower-cased words, and their offsets by row."""
    low = spans.LOWER[data]
    found = spans.words(low, offsets, spans.WORDLIKE)
    return spans.sets(spans.hashes(low, found), found, n)


def fingerprints(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set; those of an empty set are 0."""
    a = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sets)])
    b = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spans.mix(sets ^ spans.STEP))])
    return a[at[1:]] - a[at[:-1]], b[at[1:]] - b[at[:-1]]


def nodes(sets: np.ndarray, at: np.ndarray, length: int, trees: int = TREES) -> np.ndarray:
    """The trie node of each non-empty set in each tree: the hash of its signature's first `length` values."""
    full = np.flatnonzero(np.diff(at))
    low = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    out = np.zeros((len(at) - 1, trees), np.uint64)
    if not len(full):
        return out
    for t in range(trees):
        node = np.full(len(full), t + 1, np.uint64)
        for k in range(t * LONGEST, t * LONGEST + length):
            h = low * FACTORS[k]
            h ^= SHIFTS[k]
            h *= np.uint32(0x9E3779B1)
            node = node * spans.ROLL + np.minimum.reduceat(h, at[full])
        out[full, t] = spans.mix(node)
    return out


SIGNED = StructType([
    StructField("doc_id", LongType()), StructField("n_shingles", LongType()), StructField("set_a", LongType()), StructField("set_b", LongType()), StructField("nodes", ArrayType(LongType())),
])


def links(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """Rows (doc_id, class_id, n_links, n_shingles), one for each row of docs (doc_id, text).

    Two texts are linked if the Jaccard similarity of their sets of lower-cased word shingles is at least `similarity`; classes
    are what links connect, class_id is the smallest doc_id in one. n_links is the number of other rows linked to this one,
    copies included. Texts of fewer words than a shingle have one shingle, all their words. Null, empty and wordless texts have
    none, no links and a class of their own; rows with a null doc_id take no part (class_id null, 0 links). Rows with one
    doc_id and different texts are joined as one document through that id. Other columns are ignored.
    """
    length = prefix_length(similarity, recall)

    def sign(batches):
        for batch in batches:
            for part, data, at in spans.chunks(batch, "text"):
                sets, to = shingle_sets(data, at, shingle)
                a, b = fingerprints(sets, to)
                node = nodes(sets, to, length).view(np.int64)
                kept = np.diff(to) > 0
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept * TREES)]).astype(np.int32)), pa.array(node[kept].reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(to)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), listed], names=SIGNED.names)

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut_lineage(text.mapInArrow(sign, SIGNED))
    real = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("nodes").alias("nodes")))

    hung = classes.select("rep", F.posexplode("nodes").alias("tree", "node"))
    shared = hung.groupBy("tree", "node").agg(F.min("rep").alias("b"), F.count("*").alias("n")).filter("n > 1").select("tree", "node", "b")
    group = components(hung.join(shared, ["tree", "node"]).filter("rep <> b").select(F.col("rep").alias("a"), "b"))

    member = group.withColumnRenamed("id", "rep").join(classes.select("rep", "set_a", "set_b", "copies", "n_shingles"), "rep")
    size = member.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / PART_TEXTS), F.ceil(F.sum("n_shingles") / PART_SHINGLES)).cast("int").alias("parts"))
    member = cut_lineage(member.join(size, "root").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")))
    member = member.select("rep", "set_a", "set_b", "copies", "root", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    member = member.select("rep", "set_a", "set_b", "copies", "root", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    pairs = text.withColumnRenamed("doc_id", "rep").join(member, "rep")

    def verify(table: pa.Table) -> pa.Table:
        if table.nbytes > spans.CHUNK_BYTES:
            spans.give_back()
        data, at = spans.column_bytes(table.column("text"))
        sets, to = shingle_sets(data, at, shingle)
        a, b = fingerprints(sets, to)
        rep, part = spans.integers(table.column("rep"), NO_ID), spans.integers(table.column("part"), 0)
        right = (a.view(np.int64) == spans.integers(table.column("set_a"), 0)) & (b.view(np.int64) == spans.integers(table.column("set_b"), 0))
        _, once = np.unique(np.stack([rep, a.view(np.int64), b.view(np.int64)]), axis=1, return_index=True)
        rows = np.intersect1d(np.flatnonzero(right), once)
        copies = spans.integers(table.column("copies"), 1)[rows]
        linked, root = compare([sets[to[r] : to[r + 1]] for r in rows], copies, part[rows], rep[rows], similarity)
        return pa.table({"rep": pa.array(rep[rows]), "linked": pa.array(linked), "root": pa.array(root)})

    told = cut_lineage(pairs.groupBy("root", "i", "j").applyInArrow(verify, "rep long, linked long, root long"))
    final = components(told.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    count = told.groupBy("rep").agg(F.sum("linked").alias("linked"))
    result = classes.select("set_a", "set_b", "copies", "rep").join(count, "rep", "left").join(final, "rep", "left")
    result = result.select("set_a", "set_b", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("class"))
    known = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return signed.join(result, ["set_a", "set_b"], "left").select(
        "doc_id", F.when(known, F.col("class")).otherwise(F.col("doc_id")).alias("class_id"), F.when(known, F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"), "n_shingles",
    )


def compare(sets: list[np.ndarray], copies: np.ndarray, part: np.ndarray, ids: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows linked to each set, copies counted, and the smallest id that it reaches by links.

    Where two parts meet only links between them count; those inside a part are counted where it meets itself.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.float64)
    every = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    of = np.repeat(np.arange(n), size.astype(np.int64))
    _, code, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times[code] > 1
    code, of = np.unique(code[shared], return_inverse=True)[1], of[shared]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(code, kind="stable")
    code, of = code[order], of[order]
    step = max(256, (16 << 20) // max(1, 4 * n))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, step):
        i, j = np.searchsorted(code, [low, low + step])
        m = np.zeros((n, min(step, int(code[-1]) + 1 - low)), np.float32)
        m[of[i:j], code[i:j] - low] = 1
        both += m @ m.T
    near = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(near, False)
    if n and part.min() != part.max():
        near &= part[:, None] != part[None, :]
    linked = near @ copies.astype(np.float64)
    root = ids.copy()
    while n:
        low = np.where(near, root[None, :], NO_ID).min(1)
        new = np.minimum(root, low)
        if (new == root).all():
            break
        root = new
    return np.rint(linked).astype(np.int64), root
