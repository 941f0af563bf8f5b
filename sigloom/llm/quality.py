"""Text quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in overlapping chunks (1,024 bytes, a new one every 896) that cover all of it. Bytes are embedded
in 8 dimensions; 24 learned filters look at 8 bytes every 4 bytes; each filter's largest response in a chunk is kept; a linear layer
makes a chunk's logit, and the mean over the chunks is the document's. One more input of that layer is the share of places whose
four bytes also stand 2 to 24 bytes before, which filters of 8 bytes can't see. The driver fits the network on a bounded sample of
labelled rows (`SAMPLE` of each label, `SAMPLE_CHUNKS` chunks of each); the model of about 4,000 numbers goes to the tasks.
For scoring, embedding and filters are folded into one table for each of the 8 places.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from . import spans

HOP = 896
OVERLAP = 128
WIDTH = 8
STRIDE = 4
DIMENSIONS = 8
FILTERS = 24
SAMPLE = 1500
SAMPLE_CHUNKS = 3
STEPS = 700
BATCH = 64
RATE = 0.004
DECAY = 1e-4
LAG_FIRST, LAG_LAST = 2, 24
REPEAT_SCALE = 4
PLACES = HOP // STRIDE
SHARED = OVERLAP // STRIDE


class Network(NamedTuple):
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray

    def tables(self) -> list[np.ndarray]:
        return [(self.embedding @ w).astype(np.float32) for w in self.filters.reshape(WIDTH, DIMENSIONS, FILTERS)]


def layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows laid out from hop to hop with zeros behind each: (bytes, first hop of each row, bytes of text in each hop)."""
    size = np.diff(offsets)
    hops = np.maximum(1, -(-(size + WIDTH) // HOP))
    first = np.concatenate([[0], np.cumsum(hops)])
    out = np.zeros(int(first[-1]) * HOP + OVERLAP + WIDTH, np.uint8)
    out[np.arange(len(data)) + np.repeat(first[:-1] * HOP - offsets[:-1], size)] = data
    filled = np.repeat(size, hops) - (np.arange(first[-1]) - np.repeat(first[:-1], hops)) * HOP
    return out, first, np.clip(filled, 0, HOP)


def repeated(hops: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """The share of places in each row of HOP bytes whose four bytes also stand LAG_FIRST to LAG_LAST bytes before; the row's start left out."""
    flat = np.ascontiguousarray(hops).reshape(-1)
    four = np.ndarray((len(flat) - 3,), "<u4", flat.data, strides=(1,))
    four = np.concatenate([four, np.zeros(3, np.uint32)]).reshape(hops.shape)
    at = np.arange(LAG_LAST, HOP - STRIDE, STRIDE)
    now = four[:, at]
    same = np.zeros(now.shape, bool)
    for lag in range(LAG_FIRST, LAG_LAST + 1):
        same |= now == four[:, LAG_LAST - lag : HOP - STRIDE - lag : STRIDE]
    valid = at[None, :] + STRIDE <= filled[:, None]
    return ((same & valid).sum(1) / np.maximum(valid.sum(1), 1) * REPEAT_SCALE).astype(np.float32)


def pooled(tables: list[np.ndarray], bias: np.ndarray, data: np.ndarray, filled: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """Each chunk's largest filter responses, at least 0, and its repetition. A chunk is a hop and, if its text goes on, the start of the next."""
    n = len(filled)
    again = np.empty(n, np.float32)
    top, head = np.empty((n, FILTERS), np.float32), np.full((n + 1, FILTERS), -1e9, np.float32)
    for i in range(0, n, 512):
        j = min(n, i + 512)
        piece = data[i * HOP : j * HOP + WIDTH]
        act = np.take(tables[0], piece[: (j - i) * HOP : STRIDE], axis=0)
        for k in range(1, WIDTH):
            act += np.take(tables[k], piece[k : (j - i) * HOP + k : STRIDE], axis=0)
        act = act.reshape(j - i, PLACES, FILTERS)
        for r in np.flatnonzero(filled[i:j] < HOP):
            act[r, -(-int(filled[i + r]) // STRIDE) :] = -1e9
        top[i:j] = act.max(1)
        head[i:j] = act[:, :SHARED].max(1)
        again[i:j] = repeated(data[i * HOP : j * HOP].reshape(j - i, HOP), filled[i:j])
    kept = np.maximum(np.maximum(top, np.where(goes_on[:, None], head[1:], -1e9)) + bias, 0)
    return np.concatenate([kept, again[:, None]], axis=1)


def score_rows(model: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of each row."""
    out, first, filled = layout(data, offsets)
    goes_on = np.ones(len(filled), bool)
    goes_on[first[1:] - 1] = False
    logit = pooled(model.tables(), model.bias, out, filled, goes_on) @ model.weight + model.offset
    mean = np.add.reduceat(logit.astype(np.float64), first[:-1]) / np.diff(first) if len(offsets) > 1 else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(mean, -40, 40)))


def fit(chunks: np.ndarray, of: np.ndarray, label: np.ndarray, prior: float = 0.5, steps: int = STEPS, seed: int = 11) -> Network:
    """Adam on the mean loss of chunks, documents weighted alike; scores are calibrated for a share `prior` of label 1.

    chunks: (n, HOP + OVERLAP) bytes, 0 behind a text's end; of: each chunk's document; label: each document's.
    """
    r = np.random.default_rng(seed)
    p = [r.normal(0, 0.5, (256, DIMENSIONS)), r.normal(0, 0.2, (WIDTH * DIMENSIONS, FILTERS)), np.zeros(FILTERS), r.normal(0, 0.2, FILTERS + 1), np.zeros(1)]
    p = [x.astype(np.float32) for x in p]
    p[0][0] = 0
    m, v, step = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    y = label[of].astype(np.float32)
    share = np.bincount(of)[of]
    again = repeated(chunks[:, :HOP], np.minimum((chunks != 0).sum(1), HOP))
    places = (chunks.shape[1] - WIDTH) // STRIDE + 1
    window = np.arange(places)[:, None] * STRIDE + np.arange(WIDTH)[None, :]
    order = np.zeros(0, np.int64)
    while step < steps:
        while len(order) < BATCH:
            order = np.concatenate([order, r.permutation(len(chunks))])
        at, order = order[:BATCH], order[BATCH:]
        b = len(at)
        rows = chunks[at]
        # a random start, so that filters don't learn one alignment
        rows = np.roll(rows, -int(r.integers(STRIDE)), axis=1)
        seen = rows[:, window]  # b, places, width
        x = p[0][seen].reshape(b * places, WIDTH * DIMENSIONS)
        act = (x @ p[1]).reshape(b, places, FILTERS)
        act[seen[:, :, 0] == 0] = -1e9
        best = act.argmax(1)
        value = np.take_along_axis(act, best[:, None, :], 1)[:, 0] + p[2]
        hidden = np.concatenate([np.maximum(value, 0), again[at][:, None]], axis=1)
        z = hidden @ p[3] + p[4]
        g = (1 / (1 + np.exp(-z)) - y[at]) / share[at]
        g /= max(1e-6, (1 / share[at]).sum())
        back = np.where(value > 0, g[:, None] * p[3][:FILTERS], 0)  # b, filters
        chosen = x.reshape(b, places, -1)[np.arange(b)[:, None], best]  # b, filters, width * dimensions
        down = np.einsum("bf,kf->bfk", back, p[1])
        table = np.zeros_like(p[0])
        np.add.at(table, seen[np.arange(b)[:, None], best].reshape(-1), down.reshape(-1, DIMENSIONS))
        table[0] = 0
        grads = [table, np.einsum("bfk,bf->kf", chosen, back), back.sum(0), hidden.T @ g, g.sum(keepdims=True)]
        step += 1
        rate = RATE * min(1, step / 30) * (1 - 0.8 * step / steps)
        for k, d in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7) + DECAY * p[k])).astype(np.float32)
    own = min(max(label.mean(), 1e-3), 1 - 1e-3)
    shift = np.log(prior / (1 - prior)) - np.log(own / (1 - own))
    return Network(p[0], p[1], p[2], p[3], p[4] + np.float32(shift))


def sample_chunks(docs: DataFrame, each: int = SAMPLE_CHUNKS) -> DataFrame:
    """Up to `each` chunks of every text, evenly spread over it: (doc_id, label, chunk)."""

    def cut(batches):
        for batch in batches:
            for part, data, at in spans.chunks(batch, "text"):
                ids, label, made = part.column("doc_id").to_pylist(), part.column("label").to_pylist(), []
                for r in range(len(at) - 1):
                    text = data[at[r] : at[r + 1]]
                    starts = np.arange(0, max(1, len(text)), HOP)
                    for k in starts[np.unique(np.linspace(0, len(starts) - 1, min(each, len(starts))).astype(int))]:
                        made.append((ids[r], label[r], text[k : k + HOP + OVERLAP].tobytes()))
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["doc_id", "label", "chunk"])

    return docs.mapInArrow(cut, "doc_id long, label int, chunk binary")


def train(labelled: DataFrame, sample: int = SAMPLE) -> Network:
    """Fits the network on at most `sample` rows of each label (those with the smallest hashes); labelled: doc_id, text, label (0, 1).

    Rows with a null label or doc_id are left out. Scores are calibrated for equal
    shares of both labels. Without rows of both every score is the share of label 1 (0.02 to 0.98), or 0.5 without any.
    """
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("label").cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    count = {r["label"]: r["count"] for r in rows.select("label").groupBy("label").count().collect()}
    total = sum(count.values())
    prior = min(max(count.get(1, 0) / total, 0.02), 0.98) if total else 0.5
    if len(count) < 2:
        zero = [np.zeros(s, np.float32) for s in ((256, DIMENSIONS), (WIDTH * DIMENSIONS, FILTERS), FILTERS, FILTERS + 1)]
        return Network(*zero, np.array([np.log(prior / (1 - prior))], np.float32))
    parts = []
    mark = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    for label, n in count.items():
        # as a share of all hashes first, so that no more than about twice the sample is sorted
        bound = int(min(1.0, 2.0 * sample / n + 20 / n) * (1 << 30))
        parts.append(rows.filter((F.col("label") == label) & (mark < bound)).orderBy(mark, "doc_id").limit(sample))
    got = sample_chunks(parts[0].unionByName(parts[1])).collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["chunk"])))
    chunks = np.zeros((len(got), HOP + OVERLAP), np.uint8)
    for i, r in enumerate(got):
        chunks[i, : len(r["chunk"])] = np.frombuffer(r["chunk"], np.uint8)
    ids, of = np.unique([r["doc_id"] for r in got], return_inverse=True)
    label = np.zeros(len(ids), np.int64)
    label[of] = [r["label"] for r in got]
    return fit(chunks, of, label)


def score(docs: DataFrame, model: Network, column: str = "score") -> DataFrame:
    """docs (doc_id, text) with the probability of label 1 for each row: (doc_id, carried, score); carried is a struct of all columns.

    Null and empty texts have one empty chunk, whose score is the network's bias. Every byte of a text counts. Rows that repeat
    get the same score; other columns may have any name.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried"))

    def run(batches):
        for batch in batches:
            for part, data, at in spans.chunks(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("carried"), pa.array(score_rows(model, data, at))], names=["doc_id", "carried", column])

    return rows.mapInArrow(run, StructType([StructField("doc_id", LongType()), rows.schema["carried"], StructField(column, DoubleType())]))
