"""Boosted trees on binned features, many models at a time.

All models of a nested search - outer fold, inner fold, candidate - grow side by side. Rows with the same bins, folds and label have the same
gradient in every model, so they are packed into one row with the list of their draws: one Spark job a level counts the drawn ones of each
packed row, adds that many gradients to the histograms of every model that it trains, and chooses each model's splits from the merged histograms. A task hands on at
most one row for each (model, node, feature, bin); the splits, a few rows a model, come to the driver. Packed rows carry their scores as far
as the last kept round, so a job evaluates few trees.

Everything is decided by draws and sums of the rows: a run repeats bit by bit but for the order of floating sums, which gains are rounded
for.
"""

from __future__ import annotations

import random
import sys
import uuid
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import draws
from sigloom.operators.levels import unpivot_fields
from sigloom.operators.quantiles import exact_quantiles
from sigloom.session import ensure_checkpoint_dir

# workers get these functions by value: they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 16
REAL, SYNTHETIC = 0, 1
ALL = -1
#: rounds after which the rows' scores are written with them
KEEP_EVERY = 8
#: rows in all for each part into which packed rows are cut, so the longest list
PACKED = 2_000_000


#: combinations of bins, and rows of a source, up to which one task grows a candidate's models; it holds a few arrays of that length
CELLS, DRAWS = 1 << 16, 4_000_000


class Candidate(NamedTuple):
    """Parameters of one model."""

    rounds: int
    depth: int
    rate: float
    subsample: float
    min_leaf: int


class Spec(NamedTuple):
    """A model: rows of one source outside of an outer and an inner fold (`ALL`: none is left out) train it."""

    source: int
    fold: int
    inner: int
    candidate: int


class Tree(NamedTuple):
    """A heap of nodes; feature -1 is a leaf. Bins above `bin` go right."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray


def drawn_candidates(n: int, rounds: tuple[int, int] = (100, 499), depth: tuple[int, int] = (2, 5), rate: tuple[float, float] = (0.01, 0.21), subsample: tuple[float, float] = (0.6, 1.0), min_leaf: tuple[int, int] = (5, 29), seed: int = draws.SEED) -> list[Candidate]:
    """n candidates, each parameter drawn evenly from its range, bounds included."""
    r = random.Random(seed)
    return [Candidate(r.randint(*rounds), r.randint(*depth), r.uniform(*rate), r.uniform(*subsample), r.randint(*min_leaf)) for _ in range(n)]


def borders(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """For each feature the interpolated quantiles, to six digits, above which a value goes to the next bin."""
    ps = {f"q{i:03d}": i / bins for i in range(1, bins)}
    rows = exact_quantiles(unpivot_fields(df, [], features), ["field"], "value", ps, digits=6).collect()
    return {r["field"]: [r[q] for q in ps] for r in rows}


def binned(df: DataFrame, key: str, features: Sequence[str], label: str, cuts: dict[str, list[float]], k: int, inner: int, source: int, seed: int = draws.SEED) -> DataFrame:
    """Rows (key, source, fold, inner, y, u, bins); rows without a label or a feature are left out."""
    def bin_of(f: str):
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda b: F.col(f).cast("double") > b))

    fold = lambda name, n: F.floor(draws.uniform([key], name, seed=seed) * n).cast("int")
    return df.select(key, *dict.fromkeys([*features, label])).dropna(subset=[*features, label]).select(
        F.col(key).alias("key"), F.lit(source).alias("source"), fold("fold", k).alias("fold"), fold("inner", inner).alias("inner"),
        (F.col(label) == 1).cast("int").alias("y"), draws.uniform([key], "rows", seed=seed).alias("u"), F.array(*map(bin_of, features)).alias("bins"),
    )


def stored(df: DataFrame) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/boosting-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def places(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row after at most `depth` steps."""
    at = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        feature = tree.feature[at]
        inner = feature >= 0
        right = bins[rows, np.maximum(feature, 0)] > tree.bin[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def scores(trees: Sequence[Tree], candidate: Candidate, bins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bins))
    for tree in trees:
        out += candidate.rate * tree.value[places(tree, bins, candidate.depth)]
    return out


def packed(table: DataFrame, parts: int) -> DataFrame:
    """Rows (source, fold, inner, y, bins, us): one for the rows that differ in their draws alone, cut into parts by these."""
    u = F.coalesce("u", F.lit(float("nan")))
    part = F.when(F.isnan(u), 0).otherwise(F.floor(u * parts)).alias("part")
    return table.groupBy("source", "fold", "inner", "y", "bins", part).agg(F.collect_list(u).alias("us")).drop("part")


def arrays(batch) -> tuple[np.ndarray, ...]:
    """bins (rows x features), kept scores (rows x models), the number columns, and where each row's draws end."""
    n = batch.num_rows
    bins = np.asarray(batch.column("bins").flatten()).reshape(n, -1)
    kept = np.asarray(batch.column("kept").flatten()).reshape(n, -1)
    return bins, kept, *(np.asarray(batch.column(c)) for c in ("source", "fold", "inner", "y")), np.cumsum(np.asarray(batch.column("us").value_lengths()))


def counted(taken: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of each row's draws are taken."""
    return np.diff(np.concatenate([[0], np.cumsum(taken)])[np.concatenate([[0], ends])])


def one_by_one(rows: DataFrame) -> DataFrame:
    """Rows with a number `n` so many times, without it."""
    return rows.withColumn("n", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int")))).drop("n")


def trains(spec: Spec, source, fold, inner):
    return (source == spec.source) & (fold != spec.fold) & (inner != spec.inner)


def grown(batch: pa.Table, specs: dict[int, Spec], candidate: Candidate, weights: dict[int, tuple[float, float]], n_features: int, n_bins: int) -> pa.Table:
    """A row for each model of one source and candidate: its trees, and the scores of its held-out rows with their numbers.

    All models grow together over counts per combination of bins: a round counts the drawn rows per fold, inner fold, combination and label once,
    and a model's counts are the sum over the folds that train it.
    """
    bins = np.asarray(batch["bins"].combine_chunks().flatten()).reshape(batch.num_rows, -1)
    fold, inner, y = (batch[c].to_numpy() for c in ("fold", "inner", "y"))
    lists = batch["us"].combine_chunks()
    us, ends = np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths()))
    cells, cell = np.unique(bins, axis=0, return_inverse=True)
    parts, part = np.unique(np.column_stack([fold, inner]), axis=0, return_inverse=True)
    n_cells, n_parts, n_models = len(cells), len(parts), len(specs)
    place = (part.reshape(-1) * 2 + y) * n_cells + cell.reshape(-1)

    def per_part(times: np.ndarray) -> np.ndarray:
        """Rows of each part, label and combination."""
        return np.bincount(place, times, n_parts * 2 * n_cells).reshape(n_parts, 2 * n_cells)

    taught = np.array([[trains(s, s.source, f, i) for f, i in parts] for s in specs.values()], float)
    weight = np.array([weights[m] for m in specs])[:, :, None]
    score = np.zeros((n_models, n_cells))
    model = np.arange(n_models)[:, None]
    nodes = 2 ** (candidate.depth + 1) - 1
    features, borders_, values = (np.zeros((candidate.rounds, n_models, nodes), kind) for kind in (np.int32, np.int32, np.float64))
    for r in range(candidate.rounds):
        times = counted(np.modf(us * (104_729 + 7_919 * r))[0] < candidate.subsample, ends)
        n = (taught @ per_part(times)).reshape(n_models, 2, n_cells)
        p = 1 / (1 + np.exp(-score))
        g = weight[:, 1] * n[:, 1] * (1 - p) - weight[:, 0] * n[:, 0] * p
        h = (weight[:, 1] * n[:, 1] + weight[:, 0] * n[:, 0]) * p * (1 - p)
        feature, border, value = np.full((n_models, nodes), -1), np.zeros((n_models, nodes), np.int64), np.zeros((n_models, nodes))
        at = np.zeros((n_models, n_cells), np.int64)
        for level in range(candidate.depth):
            first, width = 2**level - 1, 2**level
            here = at >= first
            if not here.any():
                break
            slot = (np.broadcast_to(model, at.shape)[here] * width + at[here] - first) * n_bins
            size, of = n_models * width * n_bins, np.nonzero(here)[1]
            sums = [np.stack([np.bincount(slot + cells[of, j], v[here], size).reshape(n_models, width, n_bins) for j in range(n_features)], 2) for v in (g, h, n.sum(1))]
            gain, left, right = gains(*sums, candidate.min_leaf)
            flat = gain.reshape(n_models, width, -1)
            best = flat.argmax(2)  # of equal gains the first feature and bin
            m, node = np.nonzero(np.take_along_axis(flat, best[:, :, None], 2)[:, :, 0] > 0)
            f, b = np.divmod(best[m, node], n_bins - 1)
            feature[m, first + node], border[m, first + node] = f, b
            for side, a in ((1, left), (2, right)):
                value[m, 2 * (first + node) + side] = a[0][m, node, f, b] / np.maximum(a[1][m, node, f, b], 1e-12)
            split = feature[model, at]
            goes_right = cells[np.arange(n_cells), np.maximum(split, 0)] > border[model, at]
            at = np.where(here & (split >= 0), 2 * at + 1 + goes_right, at)
        score += candidate.rate * value[model, at]
        features[r], borders_[r], values[r] = feature, border, value
    all_rows, out = per_part(np.diff(ends, prepend=0)), []
    score = np.round(score, 9)
    for k, (m, s) in enumerate(specs.items()):
        left_out = np.array([(i == s.inner and f != s.fold) if s.inner != ALL else f == s.fold for f, i in parts], bool)
        some = np.flatnonzero(left_out)
        part_, at_ = np.nonzero(all_rows[some])
        label, c = np.divmod(at_, n_cells)
        held = [parts[some[part_], 0], label, score[k, c], all_rows[some][part_, at_].astype(np.int64)]
        out.append({"model": m, "feature": features[:, k].tobytes(), "bin": borders_[:, k].tobytes(), "value": values[:, k].tobytes()} | dict(zip(("fold", "y", "score", "n"), held, strict=True)))
    lists_ = {c: pa.list_(k) for c, k in (("fold", pa.int64()), ("y", pa.int64()), ("score", pa.float64()), ("n", pa.int64()))}
    kinds = {"model": pa.int64(), "feature": pa.binary(), "bin": pa.binary(), "value": pa.binary()} | lists_
    return pa.table({c: pa.array([row[c] for row in out], k) for c, k in kinds.items()})


GROWN = "model long, feature binary, bin binary, value binary, fold array<long>, y array<long>, score array<double>, n array<long>"


def gains(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Gain of each border in histograms whose last axis is the bin, and the sums (g, h, n) on both sides of it."""
    left = [a.cumsum(-1)[..., :-1] for a in (g, h, n)]
    whole = [a.sum(-1, keepdims=True) for a in (g, h, n)]
    right = [w - a for w, a in zip(whole, left, strict=True)]
    part = lambda a: a[0] ** 2 / np.maximum(a[1], 1e-12)
    gain = np.round(part(left) + part(right) - part(whole), 9)
    gain[(left[2] < least) | (right[2] < least)] = -np.inf
    return gain, left, right


class Boosted:
    """Trees of all models over one stored table of binned rows."""

    def __init__(self, table: DataFrame, candidates: Sequence[Candidate], specs: Sequence[Spec], n_features: int, bins: int = BINS):
        self.candidates, self.specs = list(candidates), list(specs)
        self.n_features, self.bins = n_features, bins
        self.trees: list[list[Tree]] = [[] for _ in self.specs]
        self.kept = [0] * len(self.specs)
        counts = table.groupBy("source", "fold", "inner", "y").agg(F.count(F.lit(1)).alias("n")).collect()
        rows = stored(packed(table, 1 + sum(r["n"] for r in counts) // PACKED))
        self.table = rows.withColumn("kept", F.array_repeat(F.lit(0.0), len(self.specs)))
        self.rows = max((sum(r["n"] for r in counts if r["source"] == s) for s in {r["source"] for r in counts}), default=0)
        self.grown: DataFrame | None = None
        #: weights of the two classes, balanced over the rows that train a model
        self.weights = []
        for s in self.specs:
            n = [sum(r["n"] for r in counts if r["y"] == y and r["source"] == s.source and r["fold"] != s.fold and r["inner"] != s.inner) for y in (0, 1)]
            self.weights.append(tuple(sum(n) / (2 * x) if x else 0.0 for x in n))

    def fit(self) -> Boosted:
        if 0 < self.rows <= DRAWS and self.table.select("bins").distinct().count() <= CELLS:
            return self._fit_whole()
        for r in range(max(c.rounds for c in self.candidates)):
            growing = [m for m, s in enumerate(self.specs) if r < self.candidates[s.candidate].rounds]
            size = {m: 2 ** (self.candidates[self.specs[m].candidate].depth + 1) - 1 for m in growing}
            new = {m: Tree(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n)) for m, n in size.items()}
            for level in range(max(self.candidates[self.specs[m].candidate].depth for m in growing)):
                open_ = {m: new[m] for m in growing if level < self.candidates[self.specs[m].candidate].depth and (level == 0 or (new[m].feature[2 ** (level - 1) - 1 : 2**level - 1] >= 0).any())}
                if not open_:
                    break
                for s in self.splits(open_, r, level).collect():
                    tree, node = new[s["model"]], s["node"]
                    tree.feature[node], tree.bin[node] = s["feature"], s["bin"]
                    tree.value[2 * node + 1], tree.value[2 * node + 2] = s["left"], s["right"]
            for m in growing:
                self.trees[m].append(new[m])
            if (r + 1) % KEEP_EVERY == 0:
                self._keep()
        return self

    def _fit_whole(self) -> Boosted:
        """Each source and candidate in one task."""
        jobs: dict[tuple[int, int], dict[int, Spec]] = {}
        for m, s in enumerate(self.specs):
            jobs.setdefault((s.source, s.candidate), {})[m] = s
        numbered, candidates, weights, n_features, n_bins = list(jobs.items()), self.candidates, self.weights, self.n_features, self.bins
        mine = F.element_at(F.create_map(*[x for s in sorted({s for s, _ in jobs}) for x in (F.lit(s), F.array(*[F.lit(j) for j, ((source, _), _) in enumerate(numbered) if source == s]))]), F.col("source"))
        known = self.table.filter(F.col("source").isin(*{s for s, _ in jobs}))
        dealt = known.select("fold", "inner", "y", "bins", "us", F.explode(mine).alias("job")).repartition(4 * len(jobs), "job")

        def run(key, batch):
            (_, candidate), specs = numbered[key[0].as_py()]
            return grown(batch, specs, candidates[candidate], {m: weights[m] for m in specs}, n_features, n_bins)

        self.grown = stored(dealt.groupBy("job").applyInArrow(run, GROWN))
        return self

    def trees_of(self, model: int) -> list[Tree]:
        if self.grown is None:
            return self.trees[model]
        c = self.candidates[self.specs[model].candidate]
        row = self.grown.filter(F.col("model") == model).select("feature", "bin", "value").first()
        if row is None:  # no row of its source
            return []
        feature, border, value = (np.frombuffer(row[n], k).reshape(c.rounds, -1) for n, k in (("feature", np.int32), ("bin", np.int32), ("value", np.float64)))
        return [Tree(*x) for x in zip(feature, border, value, strict=True)]

    def _pending(self) -> list[list[Tree]]:
        return [t[k:] for t, k in zip(self.trees, self.kept, strict=True)]

    def _keep(self) -> None:
        """Writes the rows' scores of all models with them."""
        pending, specs, candidates = self._pending(), self.specs, self.candidates

        def run(batches):
            for batch in batches:
                bins, kept, *_ = arrays(batch)
                now = np.column_stack([kept[:, m] + scores(pending[m], candidates[s.candidate], bins) for m, s in enumerate(specs)])
                column = pa.ListArray.from_arrays(pa.array(np.arange(len(now) + 1) * len(specs), pa.int32()), pa.array(now.ravel()))
                yield batch.set_column(batch.schema.get_field_index("kept"), "kept", column)

        self.table = stored(self.table.mapInArrow(run, self.table.schema))
        self.kept = [len(t) for t in self.trees]

    def splits(self, growing: dict[int, Tree], round_: int, level: int) -> DataFrame:
        """Rows (model, node, feature, bin, gain, left, right, n_left, n_right): the best split of each open node that has one."""
        pending, specs, candidates, weights = self._pending(), self.specs, self.candidates, self.weights
        n_features, n_bins = self.n_features, self.bins
        first, width = 2**level - 1, 2**level

        def histograms(batches):
            total = {m: np.zeros((3, width * n_features * n_bins)) for m in growing}
            for batch in batches:
                bins, kept, source, fold, inner, y, ends = arrays(batch)
                drawn = np.modf(np.asarray(batch.column("us").flatten()) * (104_729 + 7_919 * round_))[0]
                often = {s: counted(drawn < s, ends) for s in {candidates[specs[m].candidate].subsample for m in growing}}
                for m, tree in growing.items():
                    c = candidates[specs[m].candidate]
                    rows = np.flatnonzero(trains(specs[m], source, fold, inner) & (often[c.subsample] > 0))
                    x, label, times = bins[rows], y[rows], often[c.subsample][rows]
                    p = 1 / (1 + np.exp(-(kept[rows, m] + scores(pending[m], c, x))))
                    at = places(tree, x, level) - first
                    here = at >= 0
                    w = np.where(label == 1, weights[m][1], weights[m][0]) * times
                    values = (w * (label - p))[here], (w * p * (1 - p))[here], times[here]
                    for j in range(n_features):
                        cell = (at[here] * n_features + j) * n_bins + x[here, j]
                        for k, v in enumerate(values):
                            total[m][k] += np.bincount(cell, v, width * n_features * n_bins)
            for m, (g, h, n) in total.items():
                cell = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), m)), pa.array(cell), pa.array(g[cell]), pa.array(h[cell]), pa.array(n[cell])], names=["model", "cell", "g", "h", "n"])

        def choose(table: pa.Table) -> pa.Table:
            m = table["model"][0].as_py()
            cell = table["cell"].to_numpy()
            g, h, n = (np.bincount(cell, table[c].to_numpy(), width * n_features * n_bins).reshape(width, n_features, n_bins) for c in "ghn")
            gain, left, right = gains(g, h, n, candidates[specs[m].candidate].min_leaf)
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)  # of equal gains the first feature and bin
            out = []
            for node in np.flatnonzero(flat[np.arange(width), best] > 0):
                f, b = divmod(int(best[node]), n_bins - 1)
                value = [a[0][node, f, b] / max(a[1][node, f, b], 1e-12) for a in (left, right)]
                out.append((m, first + int(node), f, b, float(gain[node, f, b]), *map(float, value), int(left[2][node, f, b]), int(right[2][node, f, b])))
            columns = list(zip(*out, strict=True)) or [()] * 9
            kinds = [pa.int64()] * 4 + [pa.float64()] * 3 + [pa.int64()] * 2
            return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["model", "node", "feature", "bin", "gain", "left", "right", "n_left", "n_right"])

        found = self.table.mapInArrow(histograms, "model long, cell long, g double, h double, n double")
        return found.groupBy("model").applyInArrow(choose, "model long, node long, feature long, bin long, gain double, left double, right double, n_left long, n_right long")

    def held_out(self, models: Sequence[int], packed: bool = False) -> DataFrame:
        """Rows (model, fold, y, score) of the models' own held-out rows: the inner fold's, or the outer fold's where no inner one is left out.

        `packed` gives rows of one packed row once, with their number `n`.
        """
        trees, specs, candidates = self.trees, self.specs, self.candidates
        if self.grown is not None:
            rows = self.grown.filter(F.col("model").isin(*models)).select("model", F.inline(F.arrays_zip("fold", "y", "score", "n")))
            return rows if packed else one_by_one(rows)

        def run(batches):
            for batch in batches:
                bins, _, source, fold, inner, y, ends = arrays(batch)
                times = np.diff(ends, prepend=0)
                for m in models:
                    s = specs[m]
                    rows = np.flatnonzero((source == s.source) & ((inner == s.inner) & (fold != s.fold) if s.inner != ALL else fold == s.fold))
                    score = np.round(scores(trees[m], candidates[s.candidate], bins[rows]), 9)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), m)), *(pa.array(a[rows].astype(np.int64)) for a in (fold, y)), pa.array(score), pa.array(times[rows])], names=["model", "fold", "y", "score", "n"])

        found = self.table.mapInArrow(run, "model long, fold long, y long, score double, n long")
        return found if packed else one_by_one(found)

    def score(self, df: DataFrame, model: int, keep: str) -> DataFrame:
        """Rows (*keep, score) of one model for any table with `bins`; keep is their DDL schema."""
        trees, candidate = self.trees_of(model), self.candidates[self.specs[model].candidate]

        def run(batches):
            for batch in batches:
                bins = np.asarray(batch.column("bins").flatten()).reshape(batch.num_rows, -1)
                each, at = np.unique(bins, axis=0, return_inverse=True)
                column = pa.array(np.round(scores(trees, candidate, each), 9)[at.reshape(-1)])
                yield batch.drop_columns(["bins"]).append_column("score", column)

        names = [x.split()[0] for x in keep.split(", ")]
        return df.select(*names, "bins").mapInArrow(run, f"{keep}, score double")
