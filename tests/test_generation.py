"""Generated rows: same on every partitioning, valid keys, valid histories, plausible draws."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.bindings import generating as g
from sigloom.functions import draws
from sigloom.plans import gen_budget, gen_events, gen_versions, gen_work
from sigloom.plans.gen_entities import expand


def rows_of(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def versions(views):
    return g.stored_versions(views).cache()


@pytest.fixture(scope="module")
def work(views):
    return views.stored("generated_work", lambda: g.generated_work(views)).cache()


@pytest.fixture(scope="module")
def events(views, work):
    return views.stored("generated_events", lambda: g.generated_events(views)).cache()


def test_uniform_is_uniform_and_stable(spark):
    df = spark.range(20_000).withColumn("u", draws.uniform(["id"], "x"))
    u = np.array([r["u"] for r in df.collect()])
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and abs(u.std() - 0.2887) < 0.01
    assert rows_of(df.repartition(13), ["id"]) == rows_of(df.coalesce(1), ["id"])


def test_normal_and_probit(spark):
    z = np.array([r["z"] for r in spark.range(20_000).select(draws.normal(["id"], "z").alias("z")).collect()])
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03
    got = spark.range(1).select(*[draws.probit(F.lit(p)).alias(f"p{i}") for i, p in enumerate((0.001, 0.5, 0.975))]).first()
    assert got["p0"] == pytest.approx(-3.0902, abs=1e-3) and got["p1"] == pytest.approx(0, abs=1e-8) and got["p2"] == pytest.approx(1.95996, abs=1e-4)


def test_beta_quantile_moments(spark):
    df = spark.range(20_000).select(draws.beta_quantile(draws.uniform(["id"], "b"), F.lit(2.0), F.lit(5.0)).alias("x"))
    x = np.array([r["x"] for r in df.collect()])
    assert abs(x.mean() - 2 / 7) < 0.005 and abs(x.var() - 10 / (49 * 8)) < 0.002


def test_poisson_mean_and_cap(spark):
    df = spark.range(20_000).select(draws.poisson(draws.uniform(["id"], "p"), F.lit(1.7), F.lit(100)).alias("n"), draws.poisson(draws.uniform(["id"], "p"), F.lit(1.7), F.lit(2)).alias("c"))
    n = np.array([(r["n"], r["c"]) for r in df.collect()])
    assert abs(n[:, 0].mean() - 1.7) < 0.04 and n[:, 1].max() == 2


def test_lognormal_median_and_triangular_degenerate(spark):
    df = spark.range(20_000).select(draws.lognormal(["id"], "l", F.lit(5.0), F.lit(10.0), F.lit(20.0)).alias("x"))
    x = np.array([r["x"] for r in df.collect()])
    assert abs(np.median(x) - 11) < 0.4
    one = spark.range(1).select(draws.triangular(F.lit(0.3), F.lit(4.0), F.lit(4.0), F.lit(4.0)).alias("t")).first()
    assert one["t"] == 4.0


def test_expand_makes_every_row_once(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 10)], "g string, n int")
    got = rows_of(expand(df, F.col("n"), "i", chunk=10).select("g", "i"), ["g", "i"])
    assert got == [("a", i) for i in range(1, 26)] + [("c", i) for i in range(1, 11)]


def test_versions_do_not_depend_on_partitioning(views):
    e = g.entities(views)
    a = gen_versions.generate(e.repartition(11), g.version_profile(views), g.version_constraints(views))
    b = gen_versions.generate(e.coalesce(1), g.version_profile(views), g.version_constraints(views))
    assert rows_of(a, ["entity_id", "version"]) == rows_of(b, ["entity_id", "version"])


def test_version_histories_are_valid(views, versions):
    chk = gen_versions.self_check(versions, ["entity_id", "code", "dt_tco", "effective_from", "effective_to"]).first()
    assert (chk["n_missing"], chk["n_reversed"], chk["n_falling"], chk["n_not_one_active"]) == (0, 0, 0, 0)
    assert chk["n_entities"] == g.entities(views).count()
    d = versions.filter("version > 0").agg(F.min("delay_days"), F.count_if(F.col("dt_co") < F.col("dt_tco"))).first()
    assert d[0] >= 7 and d[1] == 0
    meta = gen_versions.rebaseline_events(versions)
    assert meta.count() == versions.filter("version > 0").count()


def test_work_packages_follow_their_versions(views, versions, work):
    bad = gen_work.self_check(work).first()
    assert bad["n_reversed"] == bad["n_bad_window"] == bad["n_bad_counts"] == bad["n_short"] == 0
    assert work.join(versions, ["entity_id", "code"], "left_anti").count() == 0
    falls = work.alias("a").join(work.alias("b"), (F.col("a.entity_id") == F.col("b.entity_id")) & (F.col("a.sow") == F.col("b.sow")) & (F.col("b.version") == F.col("a.version") + 1))
    assert falls.filter("b.pct_complete < a.pct_complete").count() == 0
    assert work.filter("version = 0 AND n_completed > 0").count() == 0
    assert work.groupBy("entity_id", "code", "sow").count().filter("count > 1").count() == 0


def test_scaling_keeps_entities_inside_the_boundary(views):
    df = gen_work.scale_to_boundary(g.placed(views).filter("sow_start >= dt_start"), floor=0.0, min_len=0)
    assert df.filter(F.col("sow_finish") > F.date_add("boundary", 1)).count() == 0


def test_events_obey_their_rules(views, events, versions):
    e = events
    assert e.filter("created < dt_start OR created > dt_end OR due < created OR resolved < created").count() == 0
    assert e.filter("(status = 'closed') <> (resolved IS NOT NULL)").count() == 0
    assert e.select("event_id").distinct().count() == e.count()
    n = e.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("m")).filter("n <> m").count()
    assert n == 0
    anchors = versions.filter("version > 0").select("entity_id", F.col("effective_from").alias("a"))
    near = e.join(anchors, "entity_id").filter("datediff(created, a) BETWEEN 0 AND 30").select("event_id").distinct()
    assert near.count() == e.filter("is_near").count()


def test_follow_ups_chain_to_parents(events):
    f = gen_events.follow_ups(events)
    parents = events.select(F.col("event_id").alias("parent_id"), F.col("created").alias("pc"), "status")
    j = f.drop("status").join(parents, "parent_id", "left")
    assert j.filter("pc IS NULL OR status NOT IN ('closed', 'overdue') OR datediff(created, pc) NOT BETWEEN 7 AND 21").count() == 0
    assert f.join(events, "event_id", "left_semi").count() == 0
    share = f.count() / events.filter("status IN ('closed', 'overdue')").count()
    assert 0.05 < share < 0.12


def test_budget_lines_stay_in_the_envelope(views):
    t = g.budget_tables(views)
    out = gen_budget.lines(g.entities(views), **t, mandatory=g.pl.MANDATORY)
    cap = t["totals"].filter("level = 'GLOBAL'").first()
    sums = out.groupBy("entity_id").agg((F.sum("amt_original") / F.max("amt_contract")).alias("r")).agg(F.max("r"), F.min("r")).first()
    assert 0 < sums[1] and sums[0] <= max(r["p90"] for r in t["totals"].collect() if r["p90"]) * 1.000001 and cap is not None
    have = out.filter(F.col("division").isin(*g.pl.MANDATORY)).groupBy("entity_id").agg(F.count_distinct("division").alias("n")).filter("n < 2").count()
    assert have == 0


def test_interpolation(spark):
    prof = spark.createDataFrame([("d", 0.0, 0.0), ("d", 0.5, 0.4), ("d", 1.0, 1.0)], "division string, decile double, p50 double")
    df = gen_budget.shapes(prof).withColumn("x", F.explode(F.array(*[F.lit(v) for v in (0.0, 0.25, 0.5, 0.75, 1.0)])))
    got = {r["x"]: r["y"] for r in df.select("x", gen_budget.interpolate(F.col("curve"), F.col("x")).alias("y")).collect()}
    assert got == pytest.approx({0.0: 0.0, 0.25: 0.2, 0.5: 0.4, 0.75: 0.7, 1.0: 1.0})
    none = spark.range(1).select(gen_budget.interpolate(F.lit(None).cast("array<struct<x:double,y:double>>"), F.lit(0.3)).alias("y")).first()
    assert none["y"] == 0.3


def test_entity_generator_fills_its_quota(views):
    from sigloom.plans import gen_entities

    out = gen_entities.generate(g.real(views), 120).cache()
    assert out.count() == 120 and out.select("entity_id").distinct().count() == 120
    assert out.filter("dt_end < dt_start OR gross_area <= 0 OR n_floors < 1 OR amt_contract <= 0").count() == 0
    r = out.agg(F.min(F.col("amt_cost") / F.col("amt_contract")), F.max(F.col("amt_cost") / F.col("amt_contract"))).first()
    assert 0.92 < r[0] <= r[1] < 1.03


def test_poisson_has_no_ceiling_of_its_own(spark):
    for mean in (100.0, 2000.0):
        df = spark.range(4000).select(draws.poisson(draws.uniform(["id"], f"p{mean}"), F.lit(mean), F.lit(None).cast("int")).alias("n"))
        got = df.agg(F.avg("n").alias("m"), F.var_samp("n").alias("v")).first()
        assert abs(got["m"] / mean - 1) < 0.02 and abs(got["v"] / mean - 1) < 0.15


def test_entities_of_an_unknown_unit_keep_their_rows(spark):
    from sigloom.plans import gen_budget

    presence = spark.createDataFrame([("GLOBAL", None, "01", 1.0), ("GLOBAL", None, "02", 1.0), ("SBU", "a", "01", 1.0)], "level string, sbu string, division string, presence_prob double")
    entities = spark.createDataFrame([(1, "a"), (2, "never seen"), (3, None)], "entity_id long, sbu string")
    got = gen_budget.present_divisions(entities, presence).groupBy("entity_id").count().collect()
    assert {r["entity_id"]: r["count"] for r in got} == {1: 2, 2: 2, 3: 2}


def test_draws_can_be_repeated_in_sql(spark):
    import duckdb

    df = spark.sql("SELECT id, CASE WHEN id % 3 > 0 THEN concat('n', id) END AS name FROM range(200)").select("id", "name", draws.uniform(["id", "name"], "x").alias("u"))
    con = duckdb.connect()
    for r in df.collect():
        name = "NULL" if r["name"] is None else f"'{r['name']}'"
        assert con.execute(f"SELECT {draws.uniform_sql([str(r['id']), name], 'x')}").fetchone()[0] == r["u"]


def test_poisson_walk_ends_late_enough(spark):
    us = [1e-12, 1e-3, 0.2, 0.5, 0.9, 0.999, 1 - 1e-9]
    for mean in (0.01, 1.0, 7.5, 60.0):
        got = spark.createDataFrame([(u,) for u in us], "u double").select("u", draws.poisson(F.col("u"), F.lit(mean), F.lit(None).cast("int")).alias("n")).collect()
        for r in got:
            p, cdf, n = np.exp(-mean), np.exp(-mean), 0
            while cdf <= r["u"]:
                n += 1
                p *= mean / n
                cdf += p
            assert r["n"] == n, (mean, r["u"])


def test_fields_of_an_unknown_unit(views):
    from sigloom.plans import gen_entities

    stats = gen_entities.field_stats(g.real(views))
    rows = views.entity.limit(3).select("entity_id", "n_floors", "gross_area").withColumn("sbu", F.when(F.col("entity_id") % 2 == 0, "never seen"))
    out = gen_entities.field_chain(rows, stats, ["entity_id"]).collect()
    assert len(out) == 3 and all(r["amt_contract"] > 0 and r["amt_cost"] > 0 and r["n_floors"] >= 1 for r in out)


def test_spikes_are_weighted_by_their_anchors(spark):
    from sigloom.plans import events

    rows = [(0.5, 3), (1.0, 1), (2.0, 4), (4.0, 2), (1.0, 2)]
    got = events.spike_profile(spark.createDataFrame(rows, "spike_ratio double, n_anchor long")).first()
    x = np.repeat([r[0] for r in rows], [r[1] for r in rows])
    want = [np.quantile(x, p, method="inverted_cdf") for p in (0.25, 0.5, 0.75)]
    assert [got["n_events"], got["p25"], got["median"], got["p75"]] == [len(x), *want]
    assert got["mean"] == pytest.approx(x.mean()) and got["stddev"] == pytest.approx(x.std(ddof=1))
    none = events.spike_profile(spark.createDataFrame([], "spike_ratio double, n_anchor long")).first()
    assert none["n_events"] == 0 and none["mean"] is None


def test_menu_draws_what_categorical_draws(spark):
    """Weights added up once give the same items, also with nulls, ties at the borders and one item."""
    weights = spark.createDataFrame([("k", "b", 0.25), ("k", "a", 0.25), ("k", "c", 0.5), ("n", "a", 1.0), ("n", "b", None), ("o", "x", 0.0), ("p", "y", 2.0)], "key string, item string, w double")
    rows = F.sort_array(F.collect_list(F.struct(F.col("item").alias("i"), F.col("w").alias("w"))))
    df = weights.groupBy("key").agg(draws.menu("item", "w").alias("menu"), rows.alias("arr")).withColumn("u", F.explode(F.array(*[F.lit(i / 8) for i in range(9)])))
    old = draws.categorical(F.col("u"), F.transform("arr", lambda x: x["i"]), F.transform("arr", lambda x: x["w"]))
    got = df.select("key", "u", draws.from_menu(F.col("u"), "menu").alias("got"), old.alias("want"), draws.categorical(F.col("u"), {"a": 0.25, "b": 0.25, "c": 0.5}, None).alias("fixed")).collect()
    assert len(got) == 36 and all(r["got"] == r["want"] for r in got)
    assert [r["got"] for r in sorted(got, key=lambda r: r["u"]) if r["key"] == "k"] == ["a", "a", "b", "b", "c", "c", "c", "c", "c"] == [r["fixed"] for r in sorted(got, key=lambda r: r["u"]) if r["key"] == "k"]


def test_few_entities_are_spread_before_they_become_many_rows(spark):
    """The adaptive planner joins small partitions into one; generated rows must not all come from that one task."""
    entities = spark.createDataFrame([(i, "u", "s", "c", "a", datetime.date(2020, 1, 1), datetime.date(2022, 1, 1)) for i in range(40)], "entity_id long, sbu string, size_category string, contract_bucket string, asset string, dt_start date, dt_end date")
    entities = entities.groupBy(*entities.columns).agg(F.count(F.lit(1)).alias("n")).drop("n")
    profile = spark.createDataFrame([], "level string, field string, sbu string, size_category string, contract_bucket string, n_projects long, p25 double, median double, p75 double")
    frequency = spark.createDataFrame([("u", w, 50.0) for w in "vwxyz"], "sbu string, sow string, pct_projects double")
    rows = gen_work.choose(entities, profile, frequency)
    assert len([n for n in rows.rdd.glom().map(len).collect() if n]) > 1
    assert rows.count() == 200


def test_entities_are_spread_before_their_divisions(spark):
    entities = spark.range(60).groupBy(F.col("id").alias("entity_id")).agg(F.count(F.lit(1)).alias("n")).withColumn("sbu", F.lit("u"))
    presence = spark.createDataFrame([("GLOBAL", None, d, 1.0) for d in "abc"] + [("SBU", "u", d, 1.0) for d in "ab"], "level string, sbu string, division string, presence_prob double")
    rows = gen_budget.present_divisions(entities, presence, ())
    assert len([n for n in rows.rdd.glom().map(len).collect() if n]) > 1
    assert rows.count() == 180


def test_codes_are_drawn_by_their_sampling_key(spark):
    """The draw whose text is put together inside the row is the draw of (entity, division, code)."""
    kinds = "level string, sbu string, division string, category string, contract_bucket string, asset string, n_projects long, p10 double, p25 double, median double, p75 double, p90 double, p99 double"
    empty = spark.createDataFrame([], kinds)
    entities = spark.range(30).select(F.col("id").alias("entity_id"), F.lit("u").alias("sbu"), F.lit(100.0).alias("amt_contract"), F.lit(None).cast("date").alias("dt_start"), F.lit(None).cast("date").alias("dt_end"))
    presence = spark.createDataFrame([("GLOBAL", None, d, 1.0) for d in "ab"], "level string, sbu string, division string, presence_prob double")
    frequency = spark.createDataFrame([(d, f"{c:02d}", 1 + c if c % 4 else None) for d in "a" for c in range(12)], "division string, cost_code string, n_projects int")
    mix = spark.createDataFrame([("a", "labor", 1.0)], "division string, category string, weight double")
    got = gen_budget.lines(entities, presence, empty, frequency, mix, empty, empty, mandatory=()).select("entity_id", "division", "cost_code")
    key = draws.sampling_key(["entity_id", "division", "cost_code"], "code", F.coalesce("n_projects", F.lit(1)))
    every = entities.select("entity_id").crossJoin(frequency).withColumn("k", key)
    lists = {r["entity_id"]: r["codes"] for r in every.groupBy("entity_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "cost_code"))), lambda x: x["cost_code"]).alias("codes")).collect()}
    taken: dict = {}
    for r in got.filter("division = 'a'").collect():
        taken.setdefault(r["entity_id"], set()).add(r["cost_code"])
    assert len(taken) == 30 and all(codes == set(lists[e][: len(codes)]) for e, codes in taken.items()) and max(map(len, taken.values())) > 2
    assert {r["cost_code"] for r in got.filter("division = 'b'").collect()} == {"GENERAL"}


def test_checks_of_task_records_write_none(spark, monkeypatch):
    """A query that reads the records once reads them as they are made; stored ones are read where there are any."""
    from sigloom.bindings import QUERIES
    from sigloom.bindings.views import Views

    day = F.lit("2020-01-01").cast("date")
    columns = {"sow": F.lit("a"), "version": F.lit(0), "effective_from": day, "effective_to": day, "sow_start": day, "sow_finish": F.date_add(day, 90), "sow_days": F.lit(90)}
    records = spark.range(3).select(F.col("id").alias("entity_id"), *[c.alias(n) for n, c in columns.items()], *[F.lit(0).alias(f"n_{n}") for n in ("total", "completed", "active", "not_started")])
    monkeypatch.setattr(g, "generated_work", lambda v: records)
    monkeypatch.setattr(Views, "stored", lambda self, name, make: pytest.fail(f"{name} is written"))
    assert QUERIES["G41_work_self_checks"](spark, "/nowhere").first()["n_rows"] == 3
    assert QUERIES["G41_work_rules"](spark, "/nowhere").first()["n_bad_counts"] == 0
    assert QUERIES["G25_record_rules"](spark, "/nowhere").first()["n_entities"] == 3
