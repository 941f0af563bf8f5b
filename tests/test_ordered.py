"""Sliced windows must equal plain windows, also when a key is cut into many slices."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.operators import windows as win
from sigloom.operators.ordered import ordered
from sigloom.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def chain(spark):
    """One key holds most rows; ties in the order column, NULL values and a NULL key."""
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 400), i, rnd.choice([None, *range(50)])) for i in range(3000)]
    rows += [(f"k{i % 40}", rnd.randint(0, 400), 10_000 + i, rnd.choice([None, *range(50)])) for i in range(600)]
    rows += [(None, rnd.randint(0, 9), 20_000 + i, i) for i in range(7)]
    return spark.createDataFrame(rows, "k string, t int, id int, x int").repartition(7)


@pytest.mark.parametrize("limit", [40, 500, 10**9])
def test_sliced_equals_plain(chain, limit):
    got = ordered(
        chain, ["k"], ["t", "id"], row_number="rn", count="n", lag={"lg": "x"}, lead={"ld": "x"}, running_sum={"rs": "x"},
        running_max={"rm": "x"}, last_value={"lv": "x"}, total={"tot": "x"}, rows_per_slice=limit,
    )
    w = W.partitionBy("k").orderBy("t", "id")
    up = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("k")
    want = chain.select(
        "k", "t", "id", "x", F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(whole).alias("n"), F.lag("x").over(w).alias("lg"),
        F.lead("x").over(w).alias("ld"), F.sum("x").over(up).alias("rs"), F.max("x").over(up).alias("rm"),
        F.last("x", ignorenulls=True).over(up).alias("lv"), F.sum("x").over(whole).alias("tot"),
    )
    a = {r["id"]: tuple(r[c] for c in want.columns) for r in got.collect()}
    b = {r["id"]: tuple(r) for r in want.collect()}
    assert a == b


def sizes_of_slices(df, limit, order):
    from sigloom.operators.ordered import borders, slice_of

    columns = ["k", *order]
    return df.filter("k = 'hot'").groupBy(slice_of(*borders(df, columns, limit), columns).alias("slice")).count().collect()


def test_hot_key_is_really_cut(chain):
    sizes = sizes_of_slices(chain, 100, ["t", "id"])
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 250


@pytest.mark.parametrize("spread", ["exp(3 * randn(5))", "cast(id % 3 as double)", "if(id % 4 = 0, null, 1.0)"])
def test_slices_of_skewed_and_tied_orders(spark, spread):
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.expr(spread).alias("t"), "id")
    sizes = sizes_of_slices(df, 1000, ["t", "id"])
    assert sum(r["count"] for r in sizes) == 200_000 and len(sizes) > 120 and max(r["count"] for r in sizes) < 2500


def test_input_is_computed_once(spark):
    """A counter in the input's plan: each row of a hot key is computed once, whatever reads it afterwards."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(3000).selectExpr("'hot' AS k", "id", "id % 7 AS x").mapInArrow(count, "k string, id long, x long")
    got = ordered(df, ["k"], ["id"], row_number="rn", running_sum={"s": "x"}, lead={"next": "x"}, rows_per_slice=100)
    rows = sorted((r["id"], r["rn"], r["s"], r["next"]) for r in got.collect())
    assert rows == [(i, i + 1, sum(j % 7 for j in range(i + 1)), (i + 1) % 7 if i < 2999 else None) for i in range(3000)]
    assert made.value == 3000


def test_plans_have_no_hints_and_few_exchanges(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    small = ordered(df, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], row_number="rn")
    cut = ordered(df, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], row_number="rn", rows_per_slice=300)
    plans = [x._jdf.queryExecution().toString() for x in (small, cut)]
    assert not any("ResolvedHint" in p or "strategy=broadcast" in p for p in plans)
    assert plans[0].split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert sorted(small.collect()) == sorted(cut.collect())


@pytest.mark.parametrize("kind", ["date", "timestamp", "double", "string", "decimal(20,3)"])
def test_borders_of_any_order_type(spark, kind):
    value = {"date": "date_add(date'2020-01-01', cast(id % 50 as int))", "timestamp": "timestamp_micros(id * 1234567 % 99991)", "double": "if(id % 9 = 0, double('nan'), 1 / (1 + id % 13))", "string": "concat('é\"', id % 40)", "decimal(20,3)": "cast(id % 70 / 3 as decimal(20,3))"}[kind]
    df = spark.range(2000).selectExpr("if(id % 5 = 0, null, id % 2) AS k", f"if(id % 11 = 0, null, {value}) AS t", "id")
    ask = dict(row_number="rn", running_sum={"s": "id"}, lag={"before": "id"})
    cut, plain = (sorted(map(str, ordered(df, ["k"], ["t", "id"], **more, **ask).collect())) for more in ({"rows_per_slice": 50}, {}))
    assert cut == plain


def test_no_keys_no_nested_loop(spark):
    from sigloom.plans.fidelity import auc

    df = spark.range(5000).selectExpr("id * 1.0 AS score", "cast(id % 7 = 0 as int) AS label")
    cut = auc(df, "score", "label", rows_per_slice=200)
    assert "NestedLoop" not in cut._jdf.queryExecution().executedPlan().toString()
    assert cut.first()["auc"] == pytest.approx(auc(df, "score", "label").first()["auc"])


@pytest.mark.parametrize("limit", [25, 10**9])
def test_exact_quantiles_match_numpy(chain, limit):
    qs = {"a": 0.1, "b": 0.5, "c": 0.99}
    got = {r["k"]: r for r in exact_quantiles(chain, ["k"], "x", qs, rows_per_slice=limit).collect()}
    data = {}
    for r in chain.collect():
        if r["x"] is not None:
            data.setdefault(r["k"], []).append(r["x"])
    assert set(got) == set(data)
    for k, xs in data.items():
        assert got[k]["n"] == len(xs)
        for name, p in qs.items():
            assert got[k][name] == pytest.approx(np.quantile(xs, p))


def test_exact_quantiles_drop_infinity_and_guard_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("inf")), ("a", 3.0), ("b", 1.0), ("b", 2.0), ("b", 9.0)], "k string, x double")
    got = {r["k"]: r["m"] for r in exact_quantiles(df, ["k"], "x", {"m": 0.5}, min_rows=3).collect()}
    assert got == {"a": None, "b": 2.0}


@pytest.mark.parametrize("limit", [60, 10**9])
def test_inversions_match_brute_force(chain, limit):
    df = chain.filter("x IS NOT NULL AND (k <> 'hot' OR id < 400)")
    got = {r["k"]: (r["n_pairs"], r["n_inversions"]) for r in win.inversions(df, "k", "t", "x", rows_per_slice=limit).filter("k IS NOT NULL").collect()}
    rows = {}
    for r in df.collect():
        rows.setdefault(r["k"], []).append((r["t"], r["x"]))
    rows.pop(None, None)
    for k, seq in rows.items():
        pairs = [(a, b) for a in seq for b in seq if a[0] < b[0]]
        assert got[k] == (len(pairs), sum(a[1] > b[1] for a, b in pairs))


@pytest.mark.parametrize("limit", [30, 10**9])
def test_minimum_gap_equals_recursion(chain, limit):
    df = chain.filter("x IS NOT NULL").withColumn("u", F.col("t") / 400.0)
    got = {}
    for r in win.spaced(df, ["k"], ["u", "id"], "u", 0.05, 0.95, rows_per_slice=limit).collect():
        got.setdefault(r["k"], []).append((r["u"], r["id"], r["spaced"]))
    for k, seq in got.items():
        last = 0.0
        for u, _id, s in sorted(seq):
            last = min(0.95, max(u, last + 0.05))
            assert s == pytest.approx(last, abs=1e-9)


def test_closing_dates_and_countdown(spark):
    df = spark.sql("""SELECT * FROM VALUES ('a', DATE'2020-01-01', 1), ('a', DATE'2020-01-01', 2), ('a', DATE'2020-03-01', 3), ('b', DATE'2021-01-01', 4) t(e, d, id)""")
    got = {r["id"]: str(r["effective_to"]) for r in win.closing_dates(df, ["e"], "d", tie=["id"]).collect()}
    assert got == {1: "2020-01-01", 2: "2020-02-29", 3: "2099-12-31", 4: "2099-12-31"}
    cd = {r["id"]: (r["n_recent"], r["is_active"]) for r in win.countdown(df, ["e"], ["d", "id"]).collect()}
    assert cd == {1: (3, False), 2: (2, False), 3: (1, True), 4: (1, True)}


def test_inversions_of_a_wide_range(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate([2**45, 5, 2**44, 7, 2**61])], "k long, t long, x long")
    got = win.inversions(df, "k", "t", "x").first()
    assert (got["n_pairs"], got["n_inversions"]) == (10, 4)
