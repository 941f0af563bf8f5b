"""Steps of checks, traces, quantiles and the entity generator that took more memory, time or bytes than their rows ask for."""

from pyspark.sql import functions as F

from sigloom.functions import draws
from sigloom.operators import windows as win
from sigloom.plans import gen_entities


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_generated_chunks_are_spread(spark):
    df = spark.createDataFrame([("a", 400), ("b", 300)], "g string, n int")
    rows = gen_entities.expand(df, F.col("n"), "i", chunk=10)
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_statistics_of_entities_are_computed_once(views):
    from sigloom.bindings import generating as g

    stats = gen_entities.field_stats(g.real(views))
    assert "Aggregate" not in plan_of(stats)
    rows = gen_entities.sample_entities(g.real(views), 50, fields=("gross_area", "amt_contract"))
    plan = plan_of(rows)
    assert "Aggregate" not in plan and "LeftOuter" in plan and "Join Inner" not in plan


def test_score_counts_grid_points_up_to_a_value(spark):
    grid = [float(i // 3) for i in range(gen_entities.GRID + 1)]
    xs = spark.createDataFrame([(x, grid) for x in (-1.0, 0.0, 0.5, 1.0, 33.0, 66.0, 67.0, 1e9)], "x double, grid array<double>")
    got = xs.select("x", gen_entities._score(F.col("grid"), F.col("x")).alias("z"), draws.probit((F.size(F.filter("grid", lambda v: v <= F.col("x"))) - 0.5) / float(gen_entities.GRID + 1)).alias("want"))
    assert all(r["z"] == r["want"] or (r["z"] != r["z"] and r["want"] != r["want"]) for r in got.collect())


def test_pairs_of_small_and_large_keys_are_counted_alike(spark):
    rows = [(k, (i * 37 + k) % 23, (i * 53 + 7 * k) % 41) for k, n in ((1, 1), (2, 9), (3, 70), (4, 64)) for i in range(n)] + [(5, None, 1), (None, 1, 2), (6, 3, 3), (6, 3, 1)]
    df = spark.createDataFrame(rows, "k long, t long, x long")
    want = {}
    for k in (1, 2, 3, 4, 6):
        own = [r for r in rows if r[0] == k]
        pairs = [(a, b) for a in own for b in own if a[1] < b[1]]
        want[k] = (len(own), len(pairs), sum(a[2] > b[2] for a, b in pairs))
    for few in (0, 9, 64, 1000):
        got = win.inversions(df, "k", "t", "x", few_rows=few)
        assert {r["k"]: (r["n_rows"], r["n_pairs"], r["n_inversions"]) for r in got.collect()} == want
    # bits of a large key are dealt by bit, so a task's memory doesn't follow the rows before they are exploded
    assert "RepartitionByExpression [k" in plan_of(win.inversions(df, "k", "t", "x"))


def test_chains_carry_only_what_their_measures_read(views):
    from sigloom.bindings.validating import tables
    from sigloom.plans import checks

    t = tables(views)
    assert set(checks._chain(t["budget"], t, "budget", True).columns) == {"entity_id", "division", "cost_code", "dt_budget", "__x", "__rn", "__before", "__next"}
    assert {"effective_to", "__next"} <= set(checks._chain(t["schedule"], t, "schedule", True).columns)


def test_tables_read_by_many_checks_are_written_once(spark, sf):
    from sigloom.bindings import QUERIES

    assert all("sigloom-checked_" in f for f in QUERIES["T10_trace_summary"](spark, sf).inputFiles())


def test_months_are_looked_up_in_their_entity(views):
    from sigloom.bindings import metrics

    joins = [line for line in plan_of(metrics.snapshot(views)).splitlines() if "Join " in line]
    assert joins and not any("month" in line for line in joins)
