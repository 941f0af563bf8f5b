import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from sigloom.operators import joins
from sigloom.operators.lookup import fallback
from sigloom.plans import evm, traces

D0 = date(2020, 1, 1)


def days(spark, rows):
    return spark.createDataFrame([(e, D0 + timedelta(days=d)) for e, d in rows], "e string, at date")


def test_window_counts_at_the_borders(spark):
    ev = days(spark, [("a", 100 + d) for d in (-60, -31, -30, 0, 30, 31)])
    an = days(spark, [("a", 100), ("b", 5)])
    out = joins.window_counts(
        joins.daily_counts(ev, "e", F.col("at")), joins.daily_counts(an, "e", F.col("at")), "e", {"n_before": (-60, -31), "n_after": (0, 30)}
    )
    got = {r["e"]: (r["n_before"], r["n_after"]) for r in out.collect()}
    assert got == {"a": (2, 2), "b": (0, 0)}


def test_near_and_nearest_match_brute_force(spark):
    rnd = random.Random(3)
    ev = [(rnd.choice("abc"), rnd.randint(0, 300)) for _ in range(200)]
    an = [(rnd.choice("ab"), rnd.randint(0, 300)) for _ in range(12)]
    e = joins.daily_counts(days(spark, ev), "e", F.col("at"))
    a = joins.daily_counts(days(spark, an), "e", F.col("at"))
    near = {(r["e"], (r["day"] - D0).days): r["is_near"] for r in joins.near_anchor(e, a, "e", 0, 30).collect()}
    dist = {(r["e"], (r["day"] - D0).days): r["min_days"] for r in joins.nearest_distance(e, a, "e").collect()}
    for k, d in set(ev):
        gaps = [d - x for y, x in an if y == k]
        assert near[k, d] == any(0 <= g <= 30 for g in gaps)
        assert dist[k, d] == (min(map(abs, gaps)) if gaps else None)


def test_spine_counts_match_brute_force(spark):
    rnd = random.Random(5)
    iv = [(e, s, s + rnd.randint(0, 90)) for e in "ab" for s in (rnd.randint(0, 400) for _ in range(9))]
    df = spark.createDataFrame([(e, D0 + timedelta(days=s), D0 + timedelta(days=f)) for e, s, f in iv], "e string, s date, f date")
    for r in joins.active_on_spine(df, "e", "s", "f", step_days=7).collect():
        d = (r["spine_day"] - D0).days
        assert r["n_active"] == sum(k == r["e"] and s <= d <= f for k, s, f in iv)


def test_fallback_order_and_minimum(spark):
    rows = spark.createDataFrame([(1, "s", "L"), (2, "s", "M"), (3, "t", "L"), (4, "u", "L")], "id int, sbu string, size_category string")
    table = spark.createDataFrame(
        [("SBU_SIZE", "s", "L", 9, 1.0), ("SBU_SIZE", "s", "M", 2, 2.0), ("SBU", "s", None, 1, 3.0), ("SBU", "t", None, 1, 4.0), ("GLOBAL", None, None, 1, 5.0)],
        "level string, sbu string, size_category string, n int, x double",
    ).withColumn("field", F.lit("f"))
    got = {r["id"]: (r["x"], r["level_used"]) for r in fallback(rows, table, "f", ["x"]).collect()}
    assert got == {1: (1.0, "SBU_SIZE"), 2: (3.0, "SBU"), 3: (4.0, "SBU"), 4: (5.0, "GLOBAL")}
    none = fallback(rows, table.filter("level = 'SBU'"), "f", ["x"]).filter("id = 4").first()
    assert none["x"] is None and none["level_used"] is None


def test_days_behind_equals_the_monthly_loop(spark):
    rnd = random.Random(11)
    rows = [(e, m, rnd.uniform(0.6, 1.25)) for e in range(6) for m in range(1, 30)]
    df = spark.createDataFrame(rows, "e int, m int, spi double")
    got = {(r["e"], r["m"]): r["days_behind"] for r in evm.days_behind(df, "e", "m", "m", "spi").collect()}
    for e in range(6):
        behind = 0
        for _e, m, spi in [r for r in rows if r[0] == e]:
            if spi < 1.0:
                behind = max(0, int(m * 30 / max(0.5, spi) - m * 30))
            else:
                behind = max(0, behind - int(5 * (spi - 1.0) * 30))
            assert got[e, m] == behind


def test_audit_needs_three_months(spark):
    rows = [(1, m, m == 2, 0.95, date(2021, 1, 1), 10 - m) for m in range(1, 5)] + [(2, m, m == 1, 0.5, date(2021, 1, 1), 10) for m in range(1, 8)]
    df = spark.createDataFrame(rows, "e int, m int, reb boolean, spi double, tco date, open int")
    got = {r["e"]: r["verdict"] for r in evm.rebaseline_audit(df, "e", "m", "reb", "spi", "tco", "open").collect()}
    assert got == {1: "inconclusive", 2: "justified"}


def test_auc_ties_and_single_class(spark):
    from sigloom.plans.fidelity import auc

    rows = [("t", 1.0, 1), ("t", 1.0, 0), ("t", 2.0, 1), ("t", 0.5, 0), ("one", 1.0, 1), ("one", 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    got = {r["g"]: r["auc"] for r in auc(df, "s", "y", ["g"]).collect()}
    assert got == {"t": 0.875}


def test_scurve_profile_is_monotone(views):
    from sigloom.plans import ledger

    pts = ledger.scurve_points(views.ledger, views.project).collect()
    seen = {}
    for r in sorted(pts, key=lambda r: (r["entity_id"], r["division"], r["decile"])):
        k = (r["entity_id"], r["division"])
        assert 0.0 <= r["cume_share"] <= 1.0 and r["cume_share"] >= seen.get(k, 0.0)
        seen[k] = r["cume_share"]


def test_timeline_without_optional_tables(spark):
    e = spark.createDataFrame([(1, date(2020, 1, 15), date(2020, 4, 2))], "entity_id int, dt_start date, dt_end date")
    w = spark.createDataFrame([(1, date(2019, 12, 1), date(2020, 2, 1))], "entity_id int, sow_start date, sow_finish date")
    got = [(r["month_str"], r["n_active_sows"], r["n_events"], r["spend"]) for r in traces.timeline(e, None, w, None).orderBy("month").collect()]
    assert got == [("2020-01", 1, None, None), ("2020-02", 1, None, None), ("2020-03", 0, None, None), ("2020-04", 0, None, None)]
