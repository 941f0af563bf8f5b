"""Steps that made a job grow faster than its rows: sketches per entity, rows read again for each lookup, candidates as rows."""

from pyspark.sql import functions as F

from sigloom.plans import work


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sequence_profile_counts_entities_without_a_sketch_for_each(spark):
    rows = [(e, s, "u" if e % 2 else None, i + 1) for e in range(30) for i, s in enumerate("abc")] + [(None, "a", "u", 1), (3, "a", "u", 2)]
    seq = spark.createDataFrame(rows, "entity_id long, sow string, sbu string, seq int")
    got = work.sequence_profile(seq)
    counts = {(r["level"], r["sow"], r["sbu"]): (r["n_occurrences"], r["n_projects"]) for r in got.collect()}
    assert counts[("GLOBAL", "a", None)] == (32, 30) and counts[("SOW_SBU", "a", "u")] == (17, 15) and counts[("SOW_SBU", "a", None)] == (15, 15)
    assert "distinct" not in plan_of(got).lower()


def scans(df, name: str) -> int:
    """How often the plan reads rows that carry a column of this name."""
    return sum(line.count(f"{name}#") > 0 for line in plan_of(df).splitlines() if "LogicalRDD" in line or "LocalRelation" in line)


def test_lookup_reads_its_rows_once_and_keeps_the_first_level(spark):
    from sigloom.operators.lookup import CONSTRAINT_CHAIN, fallback_bounds

    table = spark.createDataFrame(
        [("SOW_SBU", "u", "a", "f", '{"p25": 1.0}'), ("SOW_TYPE", None, "a", "f", '{"p25": 2.0}'), ("SOW_TYPE", None, "b", "f", "no json"), ("GLOBAL", None, None, "f", '{"p25": 9.0}')],
        "level string, sbu string, sow string, field string, bounds_json string",
    )
    rows = spark.createDataFrame([(1, "u", "a"), (2, "v", "a"), (3, "u", "c"), (4, None, None), (5, None, "a"), (5, None, "a")], "id int, sbu string, sow string")
    got = fallback_bounds(rows, table, "f", chain=CONSTRAINT_CHAIN, out="b")
    assert sorted((r["id"], r["b"].get("p25"), r["b_level_used"]) for r in got.collect()) == [
        (1, 1.0, "SOW_SBU"), (2, 2.0, "SOW_TYPE"), (3, 9.0, "GLOBAL"), (4, 9.0, "GLOBAL"), (5, 2.0, "SOW_TYPE"), (5, 2.0, "SOW_TYPE")
    ]
    assert scans(got, "id") == 1 and "distinct" not in plan_of(got).lower()


def test_codes_are_chosen_inside_the_row(views):
    from sigloom.bindings import generating as g
    from sigloom.functions import draws
    from sigloom.plans import gen_budget

    t = g.budget_tables(views)
    got = gen_budget.lines(g.entities(views), **t, mandatory=g.pl.MANDATORY)
    plan = plan_of(got)
    assert "slice(" in plan and plan.count("inline(__menu") >= 1
    one = got.groupBy("entity_id", "division").agg(F.collect_set("cost_code").alias("c")).orderBy("entity_id", "division").limit(20)
    codes = t["frequency"].join(one, "division").withColumn("k", draws.sampling_key(["entity_id", "division", "cost_code"], "code", "n_projects"))
    taken = codes.withColumn("in", F.expr("array_contains(c, cost_code)")).groupBy("entity_id", "division").agg(
        F.max(F.when(F.col("in"), F.col("k"))).alias("worst"), F.min(F.when(~F.col("in"), F.col("k"))).alias("best_left")
    )
    assert taken.filter("worst > best_left").count() == 0


def test_month_shares_are_computed_once_a_lifecycle(spark):
    from sigloom.plans import gen_budget

    budget = spark.createDataFrame([(1, "d", 1, "promo", 100.0), (1, "d", 2, "x", 10.0), (2, "none", 1, "x", 10.0), (2, None, 1, "x", 10.0)], "entity_id int, division string, cost_code int, category string, amt_original double")
    months = spark.createDataFrame([(e, m, m / 2) for e in (1, 2) for m in range(3)], "entity_id int, month int, lifecycle double")
    curves = spark.createDataFrame([("d", [(0.0, 0.2), (1.0, 1.0)])], "division string, curve array<struct<x:double,y:double>>")
    got = gen_budget.monthly_cost(budget, months, curves, windows={"w": (0.0, 1.0)}, shifts={"promo": 0.25}, mandatory=())
    assert "filter(curve" not in plan_of(got)
    x = {(r["entity_id"], r["division"], r["cost_code"], r["month"]): round(r["amt_jtd"], 6) for r in got.collect()}
    assert len(x) == 12 and x[(1, "d", 1, 0)] == 26.0 and x[(1, "d", 1, 1)] == 66.0 and x[(1, "d", 2, 1)] == 6.0 and x[(2, "none", 1, 1)] == 5.0 and x[(2, None, 1, 2)] == 0.0 + x[(2, None, 1, 2)]


def test_labels_are_chosen_inside_the_row_and_an_id_draws_once(spark):
    from sigloom.functions import draws
    from sigloom.plans import gen_work

    entities = spark.createDataFrame([(1, "u"), (2, "u"), (2, "u"), (3, "v"), (None, None)], "entity_id long, sbu string")
    profile = spark.createDataFrame([("GLOBAL", None, "n_sows_per_project", 9, 6.0, 6.0, 6.0)], "level string, sbu string, field string, n_projects long, p25 double, median double, p75 double")
    frequency = spark.createDataFrame([(u, f"s{i}", 5.0 + 7 * i) for u in "uv" for i in range(12)], "sbu string, sow string, pct_projects double")
    got = gen_work.choose(entities, profile, frequency)
    assert "slice(" in plan_of(got)
    keyed = entities.crossJoin(frequency.filter("sbu = 'u'").drop("sbu")).withColumn("k", draws.sampling_key(["entity_id", "sow"], "choose", "pct_projects"))
    best = {}
    for r in keyed.collect():
        best.setdefault(r["entity_id"], []).append((r["k"], r["sow"]))
    want = sorted((str(e), s) for e, x in best.items() for _, s in sorted(x)[:6])
    assert sorted((str(r["entity_id"]), r["sow"]) for r in got.collect()) == want


def test_dates_are_carried_without_a_fold(spark):
    from datetime import date, timedelta

    from sigloom.plans import gen_work

    moves = {1: [(0, 0), (3, -40), (-5, 2), (0, 9), (10, -3)], 2: [(0, 0), (1, 30), (400, 0), (0, -1)]}
    rows = [(e, "s", v, "x", date(2020, 1, 1), date(2020, 2, 1), 31, ds, df, 7) for e, m in moves.items() for v, (ds, df) in enumerate(m)]
    rows += [(3, None, v, "x", date(2020, 1, 1), None, None, 1, 1, 7) for v in range(2)]
    df = spark.createDataFrame(rows, "entity_id int, sow string, version int, code string, sow_start date, sow_finish date, sow_days int, __ds int, __df int, __least int")
    got = gen_work._moved(df)
    assert "collect_list" not in plan_of(got) and got.columns == ["entity_id", "sow", "version", "code", "sow_start", "sow_finish", "sow_days"]
    dates = {(r["entity_id"], r["version"]): (r["sow_start"], r["sow_finish"]) for r in got.collect()}
    for e, m in moves.items():
        s, f = date(2020, 1, 1), date(2020, 2, 1)
        for v, (ds, df_) in enumerate(m):
            s = s + timedelta(ds)
            f = f if v == 0 else max(f + timedelta(df_), s + timedelta(7))
            assert dates[(e, v)] == (s, f)
    assert dates[(3, 1)] == (date(2020, 1, 3), None)


def test_levels_from_counts_equal_those_from_sketches(spark):
    from sigloom.operators.levels import Level, counted_levels, profile_levels
    from sigloom.operators.quantiles import Stats

    rows = [(("u", "v", None)[i % 3], "ab"[i % 2], None if i % 11 == 0 else round((i * 37 % 101) / 8, 2)) for i in range(700)]
    df = spark.createDataFrame(rows, "sbu string, part string, x double")
    levels, st = (Level("SBU", ("sbu",), 5), Level("GLOBAL", ())), Stats("x", {"p10": 0.1, "m": 0.5, "p75": 0.75}, ("mean", "min", "max"), suffix="_x")
    got, old = counted_levels(df, levels, st, common=["part"], count="k", mean=("avg", 2)), profile_levels(df, levels, [st], common=["part"], count="k", extra={"avg": F.round(F.avg("x"), 2)})
    key = lambda rows: sorted(str([round(c, 9) if isinstance(c, float) else c for c in r]) for r in rows)
    assert got.columns == old.columns and got.dtypes == old.dtypes and key(got.collect()) == key(old.collect())
    assert "approx" not in plan_of(got)
    for made in (work.task_count_profile, work.completion_progression, work.count_change_profile):
        assert "counted_levels" in made.__code__.co_names


def test_long_methods_are_not_left_to_the_interpreter(spark, sf):
    from sigloom.bindings.registry import QUERIES
    from sigloom.session import METHOD_LIMIT_CONF

    spark.conf.unset(METHOD_LIMIT_CONF)
    QUERIES["A1_basic_group_stats"](spark, sf)
    assert spark.conf.get(METHOD_LIMIT_CONF) == "8000"
    spark.conf.set(METHOD_LIMIT_CONF, "9000")
    QUERIES["A1_basic_group_stats"](spark, sf)
    assert spark.conf.get(METHOD_LIMIT_CONF) == "9000"
    spark.conf.unset(METHOD_LIMIT_CONF)


def test_change_orders_are_reduced_once_for_rates_and_both_sides(spark):
    from datetime import date

    from sigloom.plans import ledger

    rows = [(e, d, date(2020, 1, 1 + m), float(e % 3 * m), -float(m % 2 * e)) for e in range(6) for d in "xy" for m in range(4) for _ in range(2)]
    rows += [(None, "x", date(2020, 1, 1), 5.0, 0.0), (99, "x", date(2020, 1, 1), 5.0, 0.0), (1, None, date(2020, 1, 1), None, None)]
    led = spark.createDataFrame(rows, "entity_id long, division string, dt_budget date, pending_in double, pending_out double")
    entities = spark.createDataFrame([(e, "uv"[e % 2] if e else None, 10.0 * (e + 1)) for e in range(6)] + [(3, "u", 20.0), (3, "v", 40.0)], "entity_id long, sbu string, amt_contract double")
    out = ledger.change_order_rates(led, entities, min_rows=1)
    assert "pending_in" not in plan_of(out) and "distinct" not in plan_of(out).lower()
    got = {(r["division"], r["level"], r["sbu"]): r for r in out.collect()}
    assert set(got) == {(d, lv, s) for d in "xy" for lv, s in (("SBU", "u"), ("SBU", "v"), ("GLOBAL", None))} | {(None, "SBU", "v"), (None, "GLOBAL", None)}
    per = [(e, s, a, m) for e, s, a in entities.collect() for m in range(4)]
    for s in ("u", "v", None):
        some = [p for p in per if s in (p[1], None)]
        r = got["x", "SBU" if s else "GLOBAL", s]
        assert (r["n_rows"], r["n_projects"]) == (len(some), len({p[0] for p in some}))
        assert r["prob_in"] == round(sum(e % 3 * m > 0 for e, _, _, m in some) / len(some), 6)
        assert r["prob_out"] == round(sum(m % 2 * e > 0 for e, _, _, m in some) / len(some), 6)
        for side, x in (("in", [2.0 * (e % 3 * m) / a for e, _, a, m in some if e % 3 * m]), ("out", [2.0 * (m % 2 * e) / a for e, _, a, m in some if m % 2 * e])):
            for name, p in (("p50", 0.5), ("p90", 0.9)):
                x.sort()
                h = (len(x) - 1) * p
                lo, hi = x[int(h)], x[min(int(h) + 1, len(x) - 1)]
                assert abs(r[f"{name}_{side}"] - (lo + (hi - lo) * (h - int(h)))) < 2e-6
    assert got[None, "GLOBAL", None]["n_rows"] == 1 and got[None, "GLOBAL", None]["p50_in"] is None


def test_values_are_counted_before_they_are_copied_for_the_levels(spark, monkeypatch):
    from sigloom.operators import ordered as o
    from sigloom.operators.levels import Level, exact_profile_levels, stack_levels
    from sigloom.operators.quantiles import exact_quantiles

    monkeypatch.setattr(o, "PLAIN_BYTES", 1 << 70)
    rows = [(("u", "v", None)[i % 3], "ab"[i % 2], "pqr"[i // 7 % 3], None if i % 11 == 0 else float("inf") if i % 97 == 0 else (i * 37 % 23) / 8) for i in range(600)]
    df = spark.createDataFrame(rows, "sbu string, part string, common string, x double")
    levels, qs = (Level("BOTH", ("sbu", "part"), 30, ("sbu",)), Level("SBU", ("sbu",), 5, ("sbu",)), Level("GLOBAL", ())), {"p10": 0.1, "m": 0.5, "p90": 0.9}
    got = exact_profile_levels(df, levels, "x", qs, common=["common"], digits=6)
    plan = plan_of(got)
    assert plan.index("Generate ") < plan.rindex("count(1)")  # the copies are above the count
    keys = ["common", "level", "sbu", "part"]
    want = exact_quantiles(stack_levels(df, levels), keys, "x", qs, min_rows=3, digits=6).filter("n >= CASE level WHEN 'BOTH' THEN 30 WHEN 'SBU' THEN 5 ELSE 0 END")
    order = lambda d: sorted(str(r) for r in d.select(*keys, "n", *qs).collect())
    assert order(got) == order(want) and len(order(got)) > 9


def test_short_keys_of_a_large_table_are_not_searched_for_slices(spark, monkeypatch):
    from sigloom.operators import ordered as o

    monkeypatch.setattr(o, "PLAIN_BYTES", 0)
    monkeypatch.setattr(o, "ROWS_PER_SLICE", 200)
    df = spark.range(4000).select(F.when(F.col("id") % 100 > 0, F.col("id") % 100).alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("x"))
    made = lambda d: o.ordered(d, ["k"], ["t"], row_number="i", running_sum={"s": "x"}, lag={"b": "x"}, lead={"a": "x"}, total={"all": "x"})
    short, hot = made(df), made(df.withColumn("k", F.when(F.col("t") % 2 == 0, F.lit(0)).otherwise(F.col("k"))))
    assert o._SLICE not in plan_of(short) and o._SLICE in plan_of(hot)
    monkeypatch.setattr(o, "PLAIN_BYTES", 1 << 70)
    assert sorted(map(str, short.collect())) == sorted(map(str, made(df).collect()))


def test_curve_points_take_the_latest_day_of_a_decile_in_one_sorted_window(spark):
    from datetime import date

    from sigloom.plans import ledger

    days = [("x", 1, 10.0), ("x", 9, -50.0), ("x", 25, 80.0), ("x", 25, 5.0), ("x", 40, None), ("x", 95, 500.0), ("y", 3, float("nan")), (None, 3, 7.0)]
    rows = [(e, d, date.fromordinal(date(2020, 1, 1).toordinal() + 10 * n), 100.0, j) for e in (1, 2, 4) for d, n, j in days] + [(e, "x", None, 300.0, 9.0) for e in (1, 2)] + [(3, "x", date(2020, 1, 1), 1.0, 1.0), (1, "x", date(2020, 5, 1), 0.0, 9e9)]
    led = spark.createDataFrame(rows, "entity_id long, division string, dt_budget date, amt_original double, amt_jtd double")
    entities = spark.createDataFrame([(1, date(2020, 1, 1), date(2022, 9, 1)), (2, None, date(2022, 9, 1)), (4, date(2020, 1, 1), date(2022, 9, 1)), (4, date(2020, 1, 1), date(2022, 9, 1))], "entity_id long, dt_start date, dt_end date")
    out = ledger.scurve_points(led, entities)
    assert "max_by" not in plan_of(out)
    got = sorted((r["entity_id"], str(r["division"]), r["decile"], round(r["cume_share"], 9)) for r in out.collect())
    want = [(None, 0.0, 7 / 100), ("x", 0.0, 0.0), ("x", 0.2, 85 / 900), ("x", 0.4, 85 / 900), ("x", 0.9, 500 / 900), ("y", 0.0, 1.0)]
    assert [g for g in got if g[0] == 1] == [(1, str(d), q, round(s, 9)) for d, q, s in want]
    assert {g[0] for g in got} == {1, 4} and [g[:3] for g in got if g[0] == 4] == [(4, *g[1:3]) for g in got if g[0] == 1]
    assert [g[3] for g in got if g[0] == 4 and g[1] == "x"] == [0.0, *[round(x / 1200, 9) for x in (85, 85, 500)]]  # an entity that comes twice counts its amounts twice
