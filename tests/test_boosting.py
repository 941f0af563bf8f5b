"""Boosted trees against a plain version, the nested search's shape, permutations, and importances of a known signal."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.plans import boosting
from sigloom.plans import fidelity as fi
from sigloom.plans.boosting import ALL, REAL, SYNTHETIC, Boosted, Candidate, Spec


@pytest.fixture(scope="module")
def rows(spark):
    """The label follows `a`, weakly `b`, and not `c`; some features and labels are missing."""
    r = random.Random(11)
    out = []
    for i in range(240):
        a, b, c = r.random(), r.gauss(0, 1), r.randint(0, 3)
        y = int(a + 0.1 * b + 0.25 * r.random() > 0.65)
        out.append((i, a if i % 60 else None, b, float(c), y if i % 50 != 7 else None))
    return spark.createDataFrame(out, "id long, a double, b double, c double, y int").repartition(3)


FEATURES = ["a", "b", "c"]


def table(rows, source=REAL):
    return boosting.binned(rows, "id", FEATURES, "y", boosting.borders(rows, FEATURES, 8), 5, 3, source)


def plain(data, spec, c, n_bins):
    """The same trees, a node at a time over lists of rows."""
    train = [r for r in data if r["source"] == spec.source and r["fold"] != spec.fold and r["inner"] != spec.inner]
    n = [sum(r["y"] == y for r in train) for y in (0, 1)]
    w = [len(train) / (2 * x) for x in n]
    score = {r["key"]: 0.0 for r in data}
    trees = []
    for k in range(c.rounds):
        some = [r for r in train if math.modf(r["u"] * (104_729 + 7_919 * k))[0] < c.subsample]
        p = {r["key"]: 1 / (1 + math.exp(-score[r["key"]])) for r in some}
        g = {r["key"]: w[r["y"]] * (r["y"] - p[r["key"]]) for r in some}
        h = {r["key"]: w[r["y"]] * p[r["key"]] * (1 - p[r["key"]]) for r in some}

        def grow(rs, depth):
            best = None
            total = lambda q, x: sum(x[r["key"]] for r in q)
            if depth:
                for f in range(len(FEATURES)):
                    for b in range(n_bins - 1):
                        left, right = [r for r in rs if r["bins"][f] <= b], [r for r in rs if r["bins"][f] > b]
                        if min(len(left), len(right)) < c.min_leaf:
                            continue
                        part = lambda q: total(q, g) ** 2 / max(total(q, h), 1e-12)
                        gain = round(part(left) + part(right) - part(rs), 9)
                        if gain > 0 and (best is None or gain > best[0] + 1e-8):
                            best = (gain, f, b, left, right)
            if best is None:
                return total(rs, g) / max(total(rs, h), 1e-12)
            return (*best[1:3], grow(best[3], depth - 1), grow(best[4], depth - 1))

        tree = grow(some, c.depth)
        trees.append(tree)
        for r in data:
            t = tree
            while isinstance(t, tuple):
                t = t[3] if r["bins"][t[0]] > t[1] else t[2]
            score[r["key"]] += c.rate * (t if isinstance(tree, tuple) else 0.0)
    return score


@pytest.mark.parametrize("keep", [2, 100])
def test_models_equal_a_plain_version(rows, monkeypatch, keep):
    monkeypatch.setattr(boosting, "KEEP_EVERY", keep)
    stored = boosting.stored(table(rows))
    candidates = [Candidate(3, 2, 0.3, 1.0, 5), Candidate(5, 1, 0.2, 0.7, 9), Candidate(2, 3, 0.5, 0.8, 3)]
    specs = [Spec(REAL, f, i, c) for f, i, c in ((ALL, ALL, 0), (1, ALL, 1), (2, 0, 2), (0, 2, 0))]
    made = Boosted(stored, candidates, specs, 3, 8).fit()
    data = [r.asDict() for r in stored.collect()]
    for m, s in enumerate(specs):
        want = plain(data, s, candidates[s.candidate], 8)
        got = {r["key"]: r["score"] for r in made.score(stored, m, "key long").collect()}
        assert got.keys() == want.keys()
        assert max(abs(got[k] - want[k]) for k in got) < 1e-6
    held = made.held_out([1, 2]).groupBy("model", "fold").count().collect()
    sizes = {(r["model"], r["fold"]): r["count"] for r in held}
    assert sizes[1, 1] == sum(r["fold"] == 1 for r in data) and not any(m == 2 and f == 2 for m, f in sizes)
    assert sum(n for (m, _), n in sizes.items() if m == 2) == sum(r["inner"] == 0 and r["fold"] != 2 for r in data)


def test_rows_with_gaps_are_left_out(rows):
    made = table(rows)
    assert made.count() == rows.dropna().count() < rows.count()
    assert {r["n"] for r in made.select(F.size("bins").alias("n")).distinct().collect()} == {3}


CANDIDATES = [Candidate(4, 2, 0.4, 1.0, 5), Candidate(1, 1, 0.1, 1.0, 60)]


def test_search_takes_the_better_candidate_and_finds_the_signal(rows):
    synth = rows.withColumn("id", F.col("id") + 1000)
    found = fi.Search(rows, synth, "id", FEATURES, "y", CANDIDATES, whole=True)
    assert len(found.models.specs) == 7 * 2 * 4 and set(found.chosen) == {*((REAL, f) for f in range(5)), (REAL, ALL), (SYNTHETIC, ALL)}
    assert sum(found.models.specs[m].candidate == 0 for m in found.chosen.values()) >= 6
    cv = found.cross_validated().first()
    assert cv["n_folds"] == 5 and cv["auc"] > 0.85 and cv["ci_low"] < cv["auc"] < cv["ci_high"]
    assert fi.auc(found.scored_by_synthetic(), "score", "y").first()["auc"] > 0.9
    imp = {r["feature"]: r for r in found.importances().collect()}
    assert set(imp) == set(FEATURES)
    for side in ("real_importance", "synth_importance"):
        assert imp["a"][side] > 0.2 > abs(imp["c"][side])


def test_permutations_keep_each_columns_values(rows):
    found = fi.Search(rows, None, "id", FEATURES, "y", CANDIDATES[1:], outer=False, whole=True)
    got = found.permuted().collect()
    base = [r for r in got if r["feature"] == -1]
    assert len(got) == 4 * len(base)
    for j in range(3):
        copy = [r for r in got if r["feature"] == j]
        for i in range(3):
            assert sorted(r["bins"][i] for r in copy) == sorted(r["bins"][i] for r in base)
        rest = lambda rs: sorted((r["y"], *(b for i, b in enumerate(r["bins"]) if i != j)) for r in rs)  # noqa: E731,B023
        assert rest(copy) == rest(base)
        assert sorted((r["y"], *r["bins"]) for r in copy) != sorted((r["y"], *r["bins"]) for r in base)


def test_drawn_candidates_lie_in_their_ranges():
    drawn = boosting.drawn_candidates(40)
    assert drawn == boosting.drawn_candidates(40) and len(set(drawn)) == 40
    for c in drawn:
        assert 100 <= c.rounds < 500 and 2 <= c.depth <= 5 and 0.01 <= c.rate <= 0.21 and 0.6 <= c.subsample <= 1 and 5 <= c.min_leaf < 30
    assert np.array_equal(boosting.places(boosting.Tree(np.array([0, -1, -1]), np.array([2, 0, 0]), np.zeros(3)), np.array([[1], [3]]), 1), [1, 2])


@pytest.mark.parametrize("most", [60, 2_000_000])
def test_rows_of_the_same_bins_are_packed(spark, monkeypatch, most):
    """Models see one row for the rows that differ in their draws alone; trees and held-out rows are those of all rows."""
    monkeypatch.setattr(boosting, "PACKED", most)
    rows = spark.range(900).select("id", F.when(F.col("id") % 90 > 0, (F.col("id") % 4).cast("double")).alias("a"), (F.col("id") % 3).cast("double").alias("b"), (F.hash("id") % 5 + F.col("id") % 4 > 2).cast("int").alias("y"))
    rows = rows.unionByName(rows.filter("id < 9 OR id > 800")).unionByName(spark.createDataFrame([(None, 1.0, 2.0, 1)] * 3, "id long, a double, b double, y int"))
    stored = boosting.stored(boosting.binned(rows, "id", ["a", "b"], "y", {"a": [0.5, 1.5, 2.5], "b": [0.5, 1.5]}, 5, 3, REAL))
    candidates, specs = [Candidate(3, 2, 0.3, 0.7, 5), Candidate(2, 2, 0.5, 1.0, 9)], [Spec(REAL, 1, ALL, 0), Spec(REAL, 2, 0, 1)]
    monkeypatch.setattr(boosting, "KEEP_EVERY", 2)
    made = Boosted(stored, candidates, specs, 2, 4).fit()
    held = made.held_out([0, 1], packed=True)
    assert made.table.count() < stored.count() if most > 60 else made.table.agg(F.max(F.size("us"))).first()[0] < 10
    assert made.table.agg(F.sum(F.size("us"))).first()[0] == stored.count()
    assert held.groupBy("model", "fold", "y", "score").agg(F.sum("n").alias("n")).exceptAll(made.held_out([0, 1]).groupBy("model", "fold", "y", "score").agg(F.count("score").alias("n"))).count() == 0
    monkeypatch.setattr("test_boosting.FEATURES", ["a", "b"])
    data = [r.asDict() | {"key": i} for i, r in enumerate(stored.collect())]
    for m, s in enumerate(specs):
        want = plain([r | {"u": float("inf") if r["u"] is None else r["u"]} for r in data], s, candidates[s.candidate], 4)
        got = sorted(r["score"] for r in made.score(stored, m, "key long").collect())
        assert len(got) == len(want) and max(abs(a - b) for a, b in zip(got, sorted(want.values()), strict=True)) < 1e-6


@pytest.mark.parametrize("limit", ["CELLS", "DRAWS"])
def test_models_grown_in_one_task_equal_those_grown_level_by_level(rows, monkeypatch, limit):
    """Also with a source without rows, and models of both sources; the whole search is one job."""
    synth = rows.withColumn("id", F.col("id") + 1000).withColumn("b", -F.col("b"))
    stored = boosting.stored(table(rows).unionByName(table(synth, SYNTHETIC)))
    candidates = [Candidate(12, 3, 0.3, 0.7, 5), Candidate(9, 2, 0.2, 1.0, 9)]
    specs = [Spec(s, f, i, c) for s, f, i, c in ((REAL, ALL, ALL, 0), (REAL, 1, ALL, 1), (REAL, 2, 0, 0), (SYNTHETIC, ALL, 2, 1), (SYNTHETIC, ALL, ALL, 0))]
    whole = Boosted(stored, candidates, specs, 3, 8).fit()
    assert whole.grown is not None and not any(whole.trees)
    monkeypatch.setattr(boosting, limit, 1)
    slow = Boosted(stored, candidates, specs, 3, 8).fit()
    assert slow.grown is None
    for m, s in enumerate(specs):
        a, b = whole.trees_of(m), slow.trees_of(m)
        assert len(a) == len(b) == candidates[s.candidate].rounds
        assert all((x.feature == y.feature).all() and (x.bin == y.bin).all() and np.allclose(x.value, y.value, atol=1e-9) for x, y in zip(a, b, strict=True))
    found = [sorted((*r[:3], round(r["score"], 7), r["n"]) for r in x.held_out(range(len(specs)), packed=True).groupBy("model", "fold", "y", F.round("score", 7).alias("score")).agg(F.sum("n").alias("n")).collect()) for x in (whole, slow)]
    assert found[0] == found[1] and len(found[0]) > 20
    assert whole.held_out([1]).count() == sum(n for m, *_, n in found[0] if m == 1)


def test_utility_searches_the_whole_range(monkeypatch):
    """The bound query takes the library's 30 candidates of 100 to 499 rounds, not fewer or shorter ones."""
    from sigloom.bindings import QUERIES
    from sigloom.bindings import fidelity as bf

    taken = {}

    class Stop(Exception):
        pass

    def search(real, synth, key, features, label, candidates, *rest, **named):
        taken["candidates"] = candidates
        raise Stop

    monkeypatch.setattr(fi, "Search", search)
    monkeypatch.setattr(bf, "halves", lambda v: (None, None))
    monkeypatch.setattr("sigloom.bindings.registry.compiled_methods", lambda spark: None)
    with pytest.raises(Stop):
        QUERIES["F8_tstr_utility"](None, "")
    assert taken["candidates"] == boosting.drawn_candidates(30) and min(c.rounds for c in taken["candidates"]) >= 100 and max(c.depth for c in taken["candidates"]) == 5
