"""Nearest neighbours by largest inner product, with randomly rotated one-bit codes.

Vectors are centred, scaled to length 1 and turned at random into a space of `CODE_BITS` dimensions or more; a code keeps each component's sign, packed in
bits, together with the vector's distance to the centre, its inner product with the centre and the one between the turned unit vector and its
code. A query's turned components are rounded to four bits, so its inner product with a code is four popcounts a word of packed bits.
From it and the scalars the inner product with the query is estimated; the estimate's error stays, but for a small
probability, within `EPSILON` standard deviations, known from the scalars. A vector is ranked exactly only if its upper bound
reaches the query's k-th best product so far in the task, or, in the task's first slice, the k-th largest lower bound.

Queries go out in blocks of at most `QUERY_BLOCK`, one pass over the vectors each, whose result is written before the next begins; the best k of
every task are merged by a window over each query. The centre is the mean of at most `SAMPLE` vectors; every vector is coded and searched.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.session import ensure_checkpoint_dir

SAMPLE = 4096
QUERY_BLOCK = 8192
#: vectors that are coded at once; the first slice of a task is smaller, as no product is known there
BATCH, FIRST = 4096, 512
QUERIES_AT_ONCE = 16
CODE_BITS = 256
EPSILON = 3.0
SEED = 5
FOUND = "query_id long, vec_id long, score double"


def rotation(dimensions: int) -> np.ndarray:
    """Random orthonormal rows that turn vectors into codes' space, the same for each number of dimensions."""
    size = max(CODE_BITS, -(-dimensions // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(SEED + dimensions).normal(size=(size, dimensions)))
    return (q * np.sign(np.diag(r))).T


class Codes:
    """One-bit codes of vectors and what estimates need."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        moved = vectors - centre
        self.norm = np.sqrt((moved * moved).sum(1))
        unit = (moved / np.maximum(self.norm, 1e-300)[:, None]) @ turn
        packed = np.packbits(unit > 0, axis=1)
        #: a row for each word of 64 bits
        self.words = np.ascontiguousarray(packed.view(np.uint64).T)
        self.ones = np.bitwise_count(self.words).sum(0, dtype=np.int64).astype(np.float32)
        size = turn.shape[1]
        #: inner product of the unit vector and its code, a vector of +-1 / sqrt(size)
        self.fit = np.maximum(np.abs(unit).sum(1) / np.sqrt(size), 1e-9)
        self.spread = np.sqrt(np.maximum(0.0, 1 / self.fit**2 - 1) / (size - 1))
        self.centred = moved @ centre


class Asked:
    """Queries, turned and rounded to four bits a component."""

    def __init__(self, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray):
        moved = queries - centre
        self.length = np.sqrt((moved * moved).sum(1))
        unit = (moved / np.maximum(self.length, 1e-300)[:, None]) @ turn
        low = unit.min(1)
        self.step = np.maximum((unit.max(1) - low) / 15, 1e-300)
        level = np.rint((unit - low[:, None]) / self.step[:, None]).astype(np.uint8)
        rounded = low[:, None] + level * self.step[:, None]
        self.planes = [np.packbits(level >> p & 1, axis=1).view(np.uint64) for p in range(4)]
        self.low, self.sum = low, rounded.sum(1)
        self.rest = np.sqrt(((unit - rounded) ** 2).sum(1) / turn.shape[1])
        self.centred = queries @ centre

    def bounds(self, codes: Codes, rows: slice, lower: bool) -> tuple[np.ndarray | None, np.ndarray]:
        """Lower (where asked for) and upper bounds of the inner product of each of these queries (rows) with each vector (columns)."""
        size, shape = len(codes.words) * 64, (rows.stop - rows.start, codes.words.shape[1])
        both, ones = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
        total = np.zeros(shape, np.float32)
        for p, plane in enumerate(self.planes):
            count = np.zeros(shape, np.uint16)
            for w, word in enumerate(codes.words):
                np.bitwise_and(word[None, :], plane[rows, w, None], out=both)
                np.bitwise_count(both, out=ones)
                count += ones
            total += count * np.float32(1 << p)
        narrow = lambda x: x[rows, None].astype(np.float32)
        # <rounded query, code> = (2 <rounded query, bits> - its sum) / sqrt(size)
        dot = total * narrow(2 * self.step) + codes.ones * narrow(2 * self.low) - narrow(self.sum)
        cosine = dot * (1 / (np.sqrt(size) * codes.fit)).astype(np.float32)
        error = np.float32(EPSILON) * (codes.spread.astype(np.float32) + narrow(self.rest) * (1 / codes.fit).astype(np.float32)) + np.float32(1e-5)
        scale = narrow(self.length) * codes.norm.astype(np.float32)
        # <v, q> = <v - c, q - c> + <v - c, c> + <c, q>
        base = codes.centred.astype(np.float32) + narrow(self.centred)
        margin = np.float32(1e-5) * np.abs(base)
        return (base - margin + (cosine - error) * scale if lower else None), base + margin + (cosine + error) * scale


def product(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products in double precision, components added in order, so that equal vectors get equal products."""
    out = np.zeros(len(vectors))
    for k in range(len(query)):
        out += vectors[:, k] * query[k]
    return out


class Best:
    """The k best products of each query so far, and how many pairs were ranked exactly."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int):
        self.queries, self.ids, self.k = vectors, ids, k
        self.centre, self.turn = centre, turn
        self.asked = Asked(vectors, centre, turn) if len(ids) else None
        self.kept: list = [(np.zeros(0, np.int64), np.zeros(0)) for _ in ids]
        self.floor = np.full(len(ids), -np.inf)
        self.ranked = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not len(self.ids) or not len(ids):
            return
        codes = Codes(vectors, self.centre, self.turn)
        for i in range(0, len(self.ids), QUERIES_AT_ONCE):
            rows = slice(i, min(i + QUERIES_AT_ONCE, len(self.ids)))
            floor = self.floor[rows]
            unknown = not np.isfinite(floor).all()
            low, high = self.asked.bounds(codes, rows, unknown)
            own = ids[None, :] == self.ids[rows, None]
            high[own] = -np.inf
            if unknown and len(ids) > self.k:
                low[own] = -np.inf
                floor = np.maximum(floor, np.partition(low, -self.k, axis=1)[:, -self.k])
            near_by = high >= floor[:, None].astype(np.float32)
            for r, near in zip(range(rows.start, rows.stop), map(np.flatnonzero, near_by & ~own), strict=True):
                self.ranked += len(near)
                if len(near):
                    self._rank(r, near, ids, vectors)

    def _rank(self, r: int, near: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        # a quick product sorts out most, the others are added up in order
        some = vectors[near]
        quick = some @ self.queries[r]
        stays = quick >= self.floor[r] - 1e-9 * (1 + np.abs(quick))
        if not stays.any():
            return
        every = np.concatenate([self.kept[r][0], ids[near[stays]]])
        scores = np.concatenate([self.kept[r][1], product(some[stays], self.queries[r])])
        first = np.lexsort((every, -scores))[: self.k]
        self.kept[r] = every[first], scores[first]
        if len(first) == self.k:
            self.floor[r] = scores[first[-1]]


def matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of doubles; NaN where a vector is null, of another length, or holds a null."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()])
    out = np.full((len(column), dimensions), np.nan)
    fits = np.flatnonzero(lengths == dimensions)
    if len(fits):
        flat = pa.compute.list_flatten(column.take(pa.array(fits))).to_numpy(zero_copy_only=False)
        out[fits] = flat.reshape(len(fits), dimensions)
    return out


def usable(x: np.ndarray) -> np.ndarray:
    return np.isfinite(x).all(1) & (x != 0).any(1)


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row of `vectors` that the condition `queries` selects its k nearest others.

    Nearness is the inner product in double precision of the vectors as they are; ties go to the smaller id. Vectors that are
    null, zero, or hold null or non-finite components take no part, nor do rows without an id or vectors of another length than
    the most frequent one (ties: the shorter). A query has as many rows as there are candidates, k at most. Rows with the same id
    are the same query and never each other's candidates; a repeated query's rows are those of its smallest vector. Other columns are
    ignored.
    """
    rows = vectors.select(F.col(id_name).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = rows.filter("id IS NOT NULL AND size(v) > 0 AND exists(v, x -> x <> 0) AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = sizes[0]["d"]
    rows = rows.filter(F.size("v") == d)
    some = rows.select("v").orderBy(F.xxhash64("id")).limit(SAMPLE).toArrow()
    centre, turn = matrix(some.column("v").combine_chunks(), d).mean(0), rotation(d)
    asked = rows.filter("asks").groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    folder = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/neighbours-{uuid.uuid4().hex}"
    for b in range(blocks):
        shared = _share(asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b), centre, turn, d)
        _pass(rows, shared, k).write.mode("append").parquet(folder)
        shared.destroy()
    found = rows.sparkSession.read.schema(FOUND).parquet(folder)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _share(asked: DataFrame, centre: np.ndarray, turn: np.ndarray, d: int):
    """One block of queries on every executor; the driver holds one block at a time."""
    block = asked.orderBy("id").toArrow()
    ids = block.column("id").to_numpy()
    vectors = matrix(block.column("v").combine_chunks(), d) if len(ids) else np.zeros((0, d))
    return asked.sparkSession.sparkContext.broadcast((vectors, ids, centre, turn))


def _pass(rows: DataFrame, shared, k: int) -> DataFrame:
    def run(batches):
        best = Best(*shared.value, k)
        d, size = best.queries.shape[1], FIRST
        for batch in batches:
            i = 0
            while i < batch.num_rows:
                part = batch.slice(i, size)
                best.add(part.column("id").to_numpy(), matrix(part.column("v"), d))
                i, size = i + size, BATCH
        full = [r for r in range(len(best.ids)) if len(best.kept[r][0])]
        for i in range(0, len(full), 4096):
            some = full[i : i + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(best.ids[some], [len(best.kept[r][0]) for r in some])), pa.array(np.concatenate([best.kept[r][0] for r in some])), pa.array(np.concatenate([best.kept[r][1] for r in some]))],
                names=["query_id", "vec_id", "score"],
            )

    return rows.select("id", "v").mapInArrow(run, FOUND)
