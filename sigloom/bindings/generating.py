"""Generators driven by the profiles of the test tables."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.bindings import generating_sql as exact
from sigloom.bindings import profiling_events as pe
from sigloom.bindings import profiling_ledger as pl
from sigloom.bindings import profiling_versions as pv
from sigloom.bindings import profiling_work as pw
from sigloom.bindings.aggregating import rounded
from sigloom.bindings.joining import FALLBACK_FROM, PROFILE_SQL, order_count_profile
from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.functions import draws, text, values
from sigloom.operators import windows as win
from sigloom.operators.aggregates import collapsed_mix
from sigloom.operators.lookup import fallback
from sigloom.plans import events, gen_budget, gen_entities, gen_events, gen_versions, gen_work, ledger, work
from sigloom.plans import versions as vp

# draws: with a u taken from the key the inverse transforms can be checked in SQL


def key_uniform(key, mod=997):
    return (F.col(key) * 7919 % mod + 0.5) / float(mod)


usql, nsql = draws.uniform_sql, draws.normal_sql
U = "((o_orderkey * 7919 % 997 + CAST(0.5 AS DOUBLE)) / 997)"


@query("G1_triangular_draw", f"""
SELECT o_orderkey, round(CASE WHEN b <= a THEN m WHEN u < (m - a) / (b - a) THEN a + sqrt(u * (b - a) * (m - a)) ELSE b - sqrt((1 - u) * (b - a) * (b - m)) END, 6) AS x
FROM (SELECT o_orderkey, {U} AS u, CAST(5 + o_orderkey % 3 AS DOUBLE) AS a, CAST(7 + o_orderkey % 3 AS DOUBLE) AS m, CAST(7 + o_orderkey % 3 + o_orderkey % 11 AS DOUBLE) AS b FROM orders)""")
def _(v):
    k = F.col("o_orderkey")
    m = (7 + k % 3).cast("double")
    x = draws.triangular(key_uniform("o_orderkey"), (5 + k % 3).cast("double"), m, m + k % 11)
    return v.table("orders", "o_orderkey").select("o_orderkey", F.round(x, 6).alias("x"))


def bounds(v):
    rows = v.project.select("entity_id", "sbu", "asset", "size_category", "contract_bucket")
    return fallback(rows, v.stored("order_counts", lambda: order_count_profile(v)), "n_orders", ["p25", "median", "p75"], min_n=30)


@query("G2_lognormal_draw", with_("project", extra=PROFILE_SQL, body=f"""
SELECT entity_id, CAST(greatest(1, least(floor(exp(ln(m + 1) + (ln(z + 1) - ln(a + 1)) / (2 * 0.6745::DOUBLE) * {nsql(['entity_id'], 'count')})), floor(z * 1.15::DOUBLE))) AS INTEGER) AS n FROM (
SELECT p.entity_id, coalesce(a.p25, b.p25, c.p25, d.p25, e.p25)::DOUBLE AS a, coalesce(a.median, b.median, c.median, d.median, e.median)::DOUBLE AS m, coalesce(a.p75, b.p75, c.p75, d.p75, e.p75)::DOUBLE AS z {FALLBACK_FROM.format(n=30)})"""))
def _(v):
    n = draws.count_from_quartiles(["entity_id"], "count", "p25", "median", "p75")
    return bounds(v).select("entity_id", n.alias("n"))


def lifecycle(v):
    return v.stored("lifecycle", lambda: events.lifecycle_profile(events.with_lifecycle(v.event_full)))


@query("G3_beta_draw")
def _(v):
    e = v.event.select("event_id", "trade").join(lifecycle(v), "trade")
    return e.select("event_id", F.round(draws.beta(["event_id"], "lifecycle", "p10", "p25", "median", "p75", "p90"), 6).alias("pct"))


@query("G4_poisson_draw", f"""
WITH u AS (SELECT DISTINCT {U} AS u, CAST(1 + o_orderkey % 4 AS DOUBLE) AS lam FROM orders),
t AS (SELECT u, lam, (SELECT count(*) FROM (SELECT sum(exp(-lam) * pow(lam, k) / factorial(CAST(k AS INTEGER))) OVER (ORDER BY k) AS c FROM (SELECT unnest(generate_series(0, 15)) AS k)) WHERE c <= u) AS n FROM u)
SELECT o_orderkey, CAST(least(7, n) AS INTEGER) AS n FROM orders JOIN t ON t.u = {U} AND t.lam = CAST(1 + o_orderkey % 4 AS DOUBLE)""")
def _(v):
    lam = (1 + F.col("o_orderkey") % 4).cast("double")
    return v.table("orders", "o_orderkey").select("o_orderkey", draws.poisson(key_uniform("o_orderkey"), lam, F.lit(7)).alias("n"))


@query("G5_categorical_draw", f"""
SELECT o_orderkey, CASE WHEN {U} < 0.093 THEN 'minimal' WHEN {U} < 0.406 THEN 'small' WHEN {U} < 0.638 THEN 'moderate' WHEN {U} < 0.817 THEN 'major' WHEN {U} < 0.898 THEN 'large' ELSE 'severe' END AS category FROM orders""")
def _(v):
    return v.table("orders", "o_orderkey").select("o_orderkey", draws.categorical(key_uniform("o_orderkey"), values.DELAY_SHARES, None).alias("category"))


@query("G6_weighted_sample", f"""
SELECT p_brand, p_type, p_partkey, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY -ln({usql(['p_partkey'], 'sample')}) / p_size, p_partkey) AS r FROM part) WHERE r <= 3""")
def _(v):
    """Three parts per brand and type, by size, without repeats: a bounded top-k over sampling keys."""
    p = v.table("part", "p_partkey", "p_brand", "p_type", "p_size")
    p = p.withColumn("key", draws.sampling_key(["p_partkey"], "sample", "p_size"))
    return win.top_k(p, ["p_brand", "p_type"], ["key", "p_partkey"], 3).select("p_brand", "p_type", "p_partkey", "rank")


@query("G7_smoothed_pmf_draw", with_("entity", body=f"""
SELECT e.entity_id, CAST(least(8, 1 + count(*) FILTER (WHERE c.cum <= {usql(['e.entity_id'], 'floors')} * c.total)) AS INTEGER) AS n_floors FROM entity e JOIN cu c USING (sbu) GROUP BY e.entity_id""", extra="""
fl AS (SELECT sbu, n_floors, count(*) AS n FROM entity WHERE n_floors IS NOT NULL GROUP BY 1, 2),
pm AS (SELECT sbu, n_floors, round(n / CAST(sum(n) OVER (PARTITION BY sbu) AS DOUBLE), 6) AS prob FROM fl),
wt AS (SELECT s.sbu, k.k, coalesce(pm.prob, 0) + 0.001::DOUBLE AS w FROM (SELECT DISTINCT sbu FROM fl) s CROSS JOIN (SELECT unnest(generate_series(1, 8)) AS k) k LEFT JOIN pm ON pm.sbu = s.sbu AND pm.n_floors = k.k),
cu AS (SELECT *, sum(w) OVER (PARTITION BY sbu ORDER BY k) AS cum, sum(w) OVER (PARTITION BY sbu) AS total FROM wt)"""))
def _(v):
    from sigloom.operators.aggregates import pmf

    shares = pmf(v.entity, ["sbu"], "n_floors").groupBy("sbu").agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_floors").cast("int"), "prob"))).alias("pmf"))
    df = v.entity.select("entity_id", "sbu").join(shares, "sbu")
    return df.select("entity_id", draws.smoothed_pmf(draws.uniform(["entity_id"], "floors"), F.col("pmf"), F.lit(1), F.lit(8)).alias("n_floors"))


@query("G8_tail_clamp", """
SELECT o_orderkey, round(CASE WHEN x > p99 THEN p99 WHEN x > p90 THEN p90 + (p99 - p90) * sqrt((x - p90) / (p99 - p90 + 1e-9)) ELSE greatest(x, p10) END, 6) AS x FROM (SELECT o_orderkey, o_totalprice AS x,
 (SELECT quantile_disc(o_totalprice, 0.1) FROM orders) AS p10, (SELECT quantile_disc(o_totalprice, 0.8) FROM orders) AS p90, (SELECT quantile_disc(o_totalprice, 0.95) FROM orders) AS p99 FROM orders)""")
def _(v):
    o = v.table("orders", "o_orderkey", "o_totalprice")
    q = o.agg(F.percentile_approx("o_totalprice", F.array(F.lit(0.1), F.lit(0.8), F.lit(0.95)), 100_000)).scalar()
    return o.withColumn("q", q).select("o_orderkey", F.round(draws.tail_clamp("o_totalprice", F.col("q")[0], F.col("q")[1], F.col("q")[2]), 6).alias("x"))


@query("G8_soft_bounds", with_("project", extra=PROFILE_SQL, body=f"""
SELECT entity_id, round(least(CASE WHEN n_orders > p75 THEN p75 * (1 + 0.2::DOUBLE * {usql(['entity_id'], 'soft:over')}) ELSE n_orders * (1 + (-0.06::DOUBLE + 0.12::DOUBLE * {usql(['entity_id'], 'soft:jitter')})) END, p75 * 1.5::DOUBLE), 6) AS x
FROM project p JOIN prof d ON d.level = 'SBU' AND d.sbu = p.sbu"""))
def _(v):
    b = order_count_profile(v).filter("level = 'SBU'").select("sbu", F.col("p75").alias("soft"), (F.col("p75") * 1.5).alias("hard"))
    df = v.project.select("entity_id", "sbu", "n_orders").join(b, "sbu")
    return df.select("entity_id", F.round(draws.soft_bound("n_orders", "soft", "hard", ["entity_id"], "soft"), 6).alias("x"))


# root entities


def real(v):
    return v.entity.select("entity_id", "sbu", "region", "asset", "n_floors", "gross_area", "amt_contract", "amt_cost", "dt_start", "dt_end").filter("dt_end >= dt_start")


def synthetic_size(v) -> int:
    """As many synthetic entities as there are customers."""
    return v.table("customer", "c_custkey").count()


@query("G9_copula_entities")
def _(v):
    base = real(v).withColumn("duration", F.datediff("dt_end", "dt_start"))
    rows = gen_entities.sample_entities(base, synthetic_size(v), fields=("gross_area", "amt_contract", "duration"), categories=("region",))
    return rounded(rows, 4)


@query("G10_field_chain")
def _(v):
    r = real(v)
    out = gen_entities.field_chain(r.select("entity_id", "sbu", "n_floors", "gross_area"), gen_entities.field_stats(r), ["entity_id"])
    return rounded(out.select("entity_id", "sbu", "n_floors", "gross_area", "amt_contract", "amt_cost"), 4)


@query("G11_business_rules", with_("entity", body="""
SELECT entity_id, CAST(CASE WHEN lower(trim(sbu)) = 'building' THEN least(f, 3) ELSE f END AS INTEGER) AS n_floors, CASE WHEN gross_area > 0 THEN round(gross_area, 2) ELSE 1 END AS gross_area,
 round(greatest(c * least(greatest(0.75::DOUBLE * coalesce(amt_cost / CASE WHEN amt_contract > 0 THEN amt_contract END, 0.985::DOUBLE) + 0.25::DOUBLE * 0.985::DOUBLE, 0.93::DOUBLE), 1.02::DOUBLE), 1), 6) AS amt_cost, greatest(dt_end, dt_start) AS dt_end
FROM (SELECT *, greatest(1, coalesce(n_floors, 1)) AS f, greatest(amt_contract, 1) AS c FROM entity WHERE dt_end IS NOT NULL)"""))
def _(v):
    df = gen_entities.business_rules(v.entity.filter("dt_end IS NOT NULL"), ["entity_id"], capped_unit="building", noise=False)
    return df.select("entity_id", "n_floors", "gross_area", F.round("amt_cost", 6).alias("amt_cost"), "dt_end")


@query("G12_fill_quota", """
SELECT o_orderpriority, o_orderkey FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i FROM orders WHERE o_totalprice >= 50000) WHERE i <= 700""")
def _(v):
    o = v.table("orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    df = o.select("o_orderpriority", "o_orderkey", F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("x"), F.lit(700).alias("quota"))
    return gen_entities.fill_quota(df, "o_orderpriority", "o_orderkey").select("o_orderpriority", "o_orderkey")


# versions


def entities(v):
    return v.project_table.select("entity_id", "sbu", "asset", "region", "size_category", "contract_bucket", "amt_contract", "gross_area", "dt_start", "dt_end").filter("dt_end > dt_start")


def version_profile(v):
    def make():
        return vp.profile_table(pv.count_profile(v), vp.milestone_profile(pv.offsets(v).filter("is_valid_ntp_tco")))

    return v.stored("version_profile", make)


def version_constraints(v):
    def make():
        ms = vp.milestone_profile(pv.offsets(v).filter("is_valid_ntp_tco"))
        d = pv.delays(v)
        return vp.constraint_table(pv.count_profile(v), vp.delay_profile(d), vp.timing_profile(d), ms)

    return v.stored("version_constraints", make)


def generated_versions(v):
    return gen_versions.generate(entities(v), version_profile(v), version_constraints(v))


def stored_versions(v):
    return v.stored("generated_versions", lambda: generated_versions(v))


@query("G13_versioned_schedules", exact.G13)
def _(v):
    return generated_versions(v)


@query("G14_delay_with_slack", f"""
SELECT o_orderkey, CAST(trunc(CASE WHEN NOT known THEN 41 ELSE greatest(least(CASE WHEN s > 150 THEN 150 * (1 + u * 0.2) ELSE s * (1 + (u * 2 - 1) * 0.06) END, 170), 7) END) AS INTEGER) AS delay_days
FROM (SELECT o_orderkey, u, known, CASE WHEN slack > 0 AND raw > slack * 0.9::DOUBLE THEN slack * 0.9::DOUBLE * (1 + u * 0.2::DOUBLE) ELSE raw END AS s FROM (SELECT o_orderkey, {U} AS u, o_orderkey % 13 <> 0 AS known, CAST(o_orderkey % 211 AS DOUBLE) AS raw, CAST(o_orderkey % 301 - 20 AS DOUBLE) AS slack FROM orders))""".replace("u * 0.2)", "u * 0.2::DOUBLE)").replace("0.06)", "0.06::DOUBLE)"))
def _(v):
    k, u = F.col("o_orderkey"), key_uniform("o_orderkey")
    d = gen_versions.delay_days((k % 211).cast("double"), (k % 301 - 20).cast("double"), F.lit(150.0), F.lit(170.0), u, u, u, k % 13 != 0, F.lit(41))
    return v.table("orders", "o_orderkey").select("o_orderkey", d.alias("delay_days"))


@query("G15_milestone_offsets", exact.G15)
def _(v):
    return gen_versions.with_offsets(entities(v), version_profile(v)).select("entity_id", "co_offset", "next_offset")


@query("G16_rebaseline_metadata", with_("version", body="""
SELECT entity_id, n AS rebaseline_number, effective_from AS dt_rebaseline, target_date AS dt_tco_revised, CAST(d AS INTEGER) AS delay_days FROM (SELECT *, row_number() OVER w - 1 AS n, date_diff('day', lag(target_date) OVER w, target_date) AS d FROM version
 WINDOW w AS (PARTITION BY entity_id ORDER BY effective_from, code)) WHERE n > 0"""))
def _(v):
    from sigloom.operators.ordered import ordered

    df = ordered(v.version.select("entity_id", "effective_from", "code", "target_date"), ["entity_id"], ["effective_from", "code"], row_number="i", lag={"p": "target_date"})
    df = df.select(
        "entity_id", (F.col("i") - 1).alias("version"), "effective_from", F.col("target_date").alias("dt_tco"), F.col("target_date").alias("dt_tco_original"),
        F.datediff("target_date", "p").alias("delay_days"), F.lit(None).cast("string").alias("delay_category"),
    )
    return gen_versions.rebaseline_events(df).select("entity_id", "rebaseline_number", "dt_rebaseline", "dt_tco_revised", "delay_days")


# work packages


def seq(v):
    """The real work packages in order, read once for all profiles of them."""
    return work.sequence(v.stored("work_windows", lambda: pw.windows(v)))


def work_tables(v):
    """Profile tables that the work-package generator reads."""
    return {
        "profile": v.stored("work_profile", lambda: work.profile_table({"n_sows_per_project": pw.sow_count_profile(v)})),
        "constraints": v.stored(
            "work_constraints",
            lambda: work.constraint_table(
                {
                    "n_tasks": (pw.task_counts(v), ["p25", "median", "p75", "p95"]),
                    "sow_duration_days": (work.duration_profile(v.stored("work_windows", lambda: pw.windows(v))), ["p25", "median", "p75", "p95"]),
                    "sequence_position": (work.sequence_profile(seq(v)).drop("n_occurrences"), ["mean", "stddev", "min", "max"]),
                }
            ),
        ),
        "frequency": v.stored("sow_frequency", lambda: work.sow_frequency(seq(v))),
        "pairs": v.stored("overlap_pairs", lambda: work.overlap_profile(work.consecutive(seq(v)))),
    }


def delta_tables(v):
    def snaps():
        return v.stored("work_snapshots", lambda: pw.snaps(v))

    return {
        "progression": v.stored("progression", lambda: work.completion_progression(snaps(), pw.entities(v))),
        "shifts": v.stored("shifts", lambda: work.date_shift_profile(snaps(), pw.entities(v))),
        "count_change": v.stored("count_change", lambda: work.count_change_profile(snaps(), pw.entities(v), min_base=2)),
    }


def chosen(v):
    t = work_tables(v)
    return gen_work.arrange(gen_work.choose(entities(v), t["profile"], t["frequency"]), t["constraints"])


def baseline(v):
    return gen_work.baseline(gen_work.needed(entities(v)), **work_tables(v))


@query("G17_sow_set_and_order", exact.G17)
def _(v):
    return chosen(v).select("entity_id", "sow", "seq", "n_sows")


@query("G18_chained_placement", exact.G18)
def _(v):
    t = work_tables(v)
    rows = gen_work.overlaps(gen_work.durations(chosen(v).withColumn("boundary", F.col("dt_end")), t["constraints"]), t["pairs"])
    return gen_work.place(rows).select("entity_id", "sow", "seq", "sow_start", "sow_finish", "sow_days", "overlap")


PLACED = """
w AS (SELECT t.entity_id, t.sow, min(t.task_start) AS sow_start, max(t.task_end) AS sow_finish, date_diff('day', min(t.task_start), max(t.task_end)) AS sow_days, any_value(p.dt_start) AS dt_start, any_value(p.dt_start) + 1500 AS boundary
 FROM task t JOIN project p USING (entity_id) WHERE sow IS NOT NULL GROUP BY 1, 2)"""


def placed(v, days=1500):
    w = work.windows(v.task, "entity_id", "sow", "task_start", "task_end").join(v.project.select("entity_id", "dt_start"), "entity_id")
    return w.withColumn("boundary", F.date_add("dt_start", days))


STRETCHED = """
SELECT entity_id, sow, s AS sow_start, d AS sow_days, s + d AS sow_finish FROM (SELECT entity_id, sow, CASE WHEN f <> 1 THEN dt_start + CAST(trunc(date_diff('day', dt_start, sow_start) * f) AS INTEGER) ELSE sow_start END AS s,
 CASE WHEN f <> 1 THEN greatest(7, CAST(trunc(sow_days * f) AS INTEGER)) ELSE CAST(sow_days AS INTEGER) END AS d
 FROM (SELECT *, CASE WHEN date_diff('day', last, boundary) > 60 AND date_diff('day', dt_start, last) > 0 THEN least(3500 / CAST(date_diff('day', dt_start, last) AS DOUBLE), 2.5::DOUBLE) ELSE 1 END AS f FROM (SELECT *, max(sow_finish) OVER (PARTITION BY entity_id) AS last FROM w)))"""


@query("G19_scale_to_boundary", with_("task", "project", extra=PLACED, body="""
SELECT entity_id, sow, s AS sow_start, d AS sow_days, s + d AS sow_finish FROM (SELECT entity_id, sow,
 CASE WHEN last > boundary THEN dt_start + greatest(0, CAST(trunc(date_diff('day', dt_start, sow_start) * f) AS INTEGER)) ELSE sow_start END AS s, CASE WHEN last > boundary THEN greatest(30, CAST(trunc(sow_days * f) AS INTEGER)) ELSE CAST(sow_days AS INTEGER) END AS d
 FROM (SELECT *, CASE WHEN last > boundary AND date_diff('day', dt_start, last) > 0 THEN greatest(1500 / CAST(date_diff('day', dt_start, last) AS DOUBLE), 0.5::DOUBLE) ELSE 1 END AS f FROM (SELECT *, max(sow_finish) OVER (PARTITION BY entity_id) AS last FROM w)))"""))
def _(v):
    return gen_work.scale_to_boundary(placed(v)).select("entity_id", "sow", "sow_start", "sow_days", "sow_finish")


@query("G19_stretch_to_boundary", with_("task", "project", extra=PLACED.replace("1500", "3500"), body=STRETCHED))
def _(v):
    return gen_work.stretch_to_boundary(placed(v, 3500)).select("entity_id", "sow", "sow_start", "sow_days", "sow_finish")


@query("G20_overrun_or_clip", exact.G20)
def _(v):
    t = work_tables(v)
    rows = gen_work.overlaps(gen_work.durations(chosen(v).withColumn("boundary", F.col("dt_end")), t["constraints"]), t["pairs"])
    rows = gen_work.overrun_or_clip(gen_work.scale_to_boundary(gen_work.place(rows)))
    return rows.select("entity_id", "sow", "seq", "sow_start", "sow_finish", "sow_days", "boundary")


MIN_TABLE = {"PROMO": 2000, "SMALL": 1000}


@query("G21_minimum_durations", with_("task", "project", extra=PLACED, body="""
SELECT entity_id, sow, CASE WHEN sow_finish < sow_start OR sow_days < m THEN sow_start + m ELSE sow_finish END AS sow_finish, CAST(CASE WHEN sow_finish < sow_start OR sow_days < m THEN m ELSE sow_days END AS INTEGER) AS sow_days
FROM (SELECT *, CASE sow WHEN 'PROMO' THEN 2000 WHEN 'SMALL' THEN 1000 ELSE 7 END AS m FROM w)"""))
def _(v):
    return gen_work.repair_dates(placed(v), MIN_TABLE).select("entity_id", "sow", "sow_finish", "sow_days")


@query("G22_boundary_resolution", with_("entity", body="""
SELECT entity_id, coalesce(greatest(a, b), dt_start) AS boundary FROM (SELECT entity_id, dt_start, dt_end AS a, CASE WHEN n_floors > 5 THEN DATE '2000-01-01' END AS b FROM entity)"""))
def _(v):
    df = v.entity.withColumn("b", F.when(F.col("n_floors") > 5, F.lit("2000-01-01").cast("date")))
    return df.select("entity_id", gen_work.boundary("dt_end", "b", "dt_start").alias("boundary"))


def deltas(v):
    return gen_work.version_deltas(baseline(v), stored_versions(v), **delta_tables(v))


@query("G23_version_deltas")
def _(v):
    return deltas(v).select("entity_id", "sow", "version", "pct_complete", "n_tasks", "sow_start", "sow_finish", "sow_days")


@query("G24_drift_cap", with_("task", "project", extra=PLACED, body=f"""
SELECT entity_id, sow, s AS sow_start, f AS sow_finish, CAST(date_diff('day', s, f) AS INTEGER) AS sow_days FROM (
 SELECT entity_id, sow, CASE WHEN sow_finish > top AND sow_start >= top THEN top - 30 ELSE sow_start END AS s, CASE WHEN sow_finish > top THEN top ELSE sow_finish END AS f FROM (
 SELECT *, boundary + CAST(trunc(180 * (1 + (1.15::DOUBLE - 1) * {usql(['entity_id', 'sow'], 'drift')})) AS INTEGER) AS top FROM w))"""))
def _(v):
    return gen_work.cap_drift(placed(v), keys=("entity_id", "sow")).select("entity_id", "sow", "sow_start", "sow_finish", "sow_days")


def generated_work(v):
    return gen_work.generate(entities(v), stored_versions(v), **work_tables(v), **delta_tables(v))


def task_records(v):
    """The stored records where there are any; a query that reads them once doesn't write them first."""
    return v.stored("generated_work", lambda: generated_work(v)) if v.is_stored("generated_work") else generated_work(v)


@query("G25_task_records")
def _(v):
    return generated_work(v)


def dependency_sql(name, bands):
    whens = " ".join(f"WHEN x < {edge} THEN {b}::DOUBLE + {w}::DOUBLE * u" for edge, (b, w) in zip((0.25, 0.5, 0.75, 2), bands))
    return f"(SELECT round(CASE {whens} END, 2) FROM (SELECT seq / CAST(n AS DOUBLE) AS x, {usql(['entity_id', 'sow'], name)} AS u)) AS {name}"


BANDS = {
    "avg_n_predecessors": ((0.5, 1.5), (1.5, 2.0), (2.0, 2.0), (2.5, 2.5)), "avg_n_successors": ((2.0, 3.0), (1.5, 2.0), (0.5, 1.5), (0.2, 1.0)),
    "pct_critical_path": ((2.0, 4.0), (3.0, 6.0), (1.5, 3.5), (1.0, 3.0)),
}


@query("G26_dependency_metrics", with_("task", "project", extra=pw.WORK, body=f"""
SELECT entity_id, sow, {', '.join(dependency_sql(k, b) for k, b in BANDS.items())} FROM (SELECT entity_id, sow, row_number() OVER (PARTITION BY entity_id ORDER BY sow_start, sow) AS seq, count(*) OVER (PARTITION BY entity_id) AS n FROM w)"""))
def _(v):
    s = pw.seq(v).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("entity_id")))
    return s.select("entity_id", "sow", *[c.alias(n) for n, c in gen_work.dependency_metrics(F.col("seq") / F.col("n"), ["entity_id", "sow"]).items()])


# events

MAPPING = {"error": ("PROMO", "SMALL"), "click": ("LARGE",), "view": ("ECONOMY",), "purchase": ("MEDIUM", "STANDARD")}


def event_entities(v):
    size = F.when(F.col("duration") < 29, "short").otherwise("long")
    return v.event_project.withColumn("size_category", size).select("entity_id", "sbu", "size_category")


def event_constraints(v):
    return v.stored(
        "event_constraints", lambda: events.constraint_table({("n_events_per_entity", None): (events.count_profile(pe.counts(v)), ("p25", "median", "p75", "p90"))})
    )


def anchors(v):
    return stored_versions(v).filter("version > 0").select("entity_id", F.col("effective_from").alias("day"))


def active_work(v):
    """Where and when the active version has each work package: all that events read of the task records. Records that are stored are read."""
    columns = ("entity_id", "sow", "sow_start", "sow_finish")
    rows = task_records(v).filter("is_active").select(*columns)
    return rows if v.is_stored("generated_work") else v.stored("active_work", lambda: rows)


def generated_events(v):
    lc = lifecycle(v)
    status = v.stored("status_mix", lambda: events.status_distribution(v.event_full, "trade", ("view", "click", "purchase")))
    zones = v.stored("zones", lambda: events.zone_shares(events.with_lifecycle(v.event_full)))
    flags = v.stored("flags", lambda: events.flag_rate(v.event_full, F.col("days") > 60))
    trades = v.stored("trades", lambda: events.trade_weights(v.event_full))
    return gen_events.generate(
        entities(v), event_constraints(v), trades, lc, zones, status, flags, active_work(v), anchors(v), mapping=MAPPING
    )


@query("G27_structured_events")
def _(v):
    return generated_events(v)


@query("G28_event_dates", with_("task", "project", extra=PLACED, body=f"""
SELECT entity_id, sow, least(greatest(CASE WHEN lo <= hi THEN lo + CAST(floor(u * (date_diff('day', lo, hi) + 1)) AS INTEGER) ELSE dt_start + CAST(trunc(40 / CAST(100 AS DOUBLE) * 1500) AS INTEGER) END, dt_start), boundary) AS created FROM (
 SELECT *, greatest(CASE zone WHEN 'pre_sow' THEN sow_start - lead WHEN 'post_sow' THEN sow_finish + 1 ELSE sow_start END, dt_start) AS lo, least(CASE zone WHEN 'pre_sow' THEN sow_start - 1 WHEN 'post_sow' THEN sow_finish + 30 ELSE sow_finish END, boundary) AS hi FROM (
 SELECT *, CASE entity_id % 3 WHEN 0 THEN 'pre_sow' WHEN 1 THEN 'during_sow' ELSE 'post_sow' END AS zone, (entity_id * 7919 % 997 + 0.5::DOUBLE) / 997 AS u, greatest(14, least(60, CAST(trunc(date_diff('day', dt_start, sow_start) * 0.15::DOUBLE) AS INTEGER))) AS lead FROM w))"""))
def _(v):
    k = F.col("entity_id")
    zone = F.when(k % 3 == 0, "pre_sow").when(k % 3 == 1, "during_sow").otherwise("post_sow")
    df = placed(v).withColumn("w", F.struct("sow_start", "sow_finish"))
    at = gen_events.event_date(zone, F.lit(40.0), F.col("dt_start"), F.col("boundary"), F.col("w"), key_uniform("entity_id"))
    return df.select("entity_id", "sow", at.alias("created"))


@query("G29_status_rules", with_("event_full", body="""
SELECT event_id, CASE WHEN s = 'open' AND date_diff('day', dt_start, created) / CAST(greatest(duration, 1) AS DOUBLE) >= 0.7 AND created + 2 < dt_end AND (event_id * 7919 % 997 + 0.5::DOUBLE) / 997 < 0.15 THEN 'overdue' ELSE s END AS status
FROM (SELECT *, CASE WHEN trade IN ('view', 'click') THEN 'closed' ELSE 'open' END AS s FROM event_full)"""))
def _(v):
    s = F.when(F.col("trade").isin("view", "click"), "closed").otherwise("open")
    st = gen_events.status_rules(s, F.col("created"), F.date_add("created", 2), F.col("dt_start"), F.col("dt_end"), key_uniform("event_id"))
    return v.event_full.select("event_id", st.alias("status"))


@query("G30_spike_uplift", exact.G30)
def _(v):
    return gen_events.event_count(event_entities(v), event_constraints(v), v.event.filter("trade = 'error'").select("entity_id").distinct()).select("entity_id", "n_events")


@query("G31_near_anchor_flag", with_("event", body="""
SELECT event_id, EXISTS (SELECT 1 FROM event a WHERE a.trade = 'error' AND a.entity_id = e.entity_id AND date_diff('day', a.created, e.created) BETWEEN 0 AND 2) AS is_near FROM event e WHERE trade <> 'error'"""))
def _(v):
    an = v.event.filter("trade = 'error'").select("entity_id", F.col("created").alias("day"))
    return gen_events.with_near_flag(v.event.filter("trade <> 'error'"), an, window=2).select("event_id", "is_near")


@query("G32_follow_ups")
def _(v):
    e = v.stored("generated_events", lambda: generated_events(v))
    return gen_events.follow_ups(e).select("event_id", "parent_id", "entity_id", "seq", "created", "due", "resolved", "status")


@query("G33_balanced_categories", """
SELECT trade, code AS category, count(*) AS n FROM (SELECT event_type AS trade, row_number() OVER (PARTITION BY event_type) AS i FROM events) e JOIN (SELECT p_type AS code, row_number() OVER (ORDER BY p_type) - 1 AS j FROM (SELECT DISTINCT p_type FROM part)) m ON (e.i - 1) % 6 = m.j GROUP BY 1, 2""")
def _(v):
    trades = v.event.select("trade").distinct()
    types = v.table("part", "p_type").select(F.col("p_type").alias("code")).distinct().agg(F.collect_list("code")).scalar()
    menu = trades.withColumn("c", types).select("trade", F.explode("c").alias("code"))
    dealt = gen_events.balanced_categories(v.event.select("event_id", "trade"), "trade", "event_id", "event_id", menu)
    return dealt.groupBy("trade", "category").agg(F.count(F.lit(1)).alias("n"))


@query("G34_text_batches", with_("event", body="""
SELECT event_id, is_catchall, group_zone, group_sow, CAST(ceil(row_number() OVER (PARTITION BY entity_id, trade, group_zone, group_sow, is_catchall ORDER BY event_id) / CAST(20 AS DOUBLE)) AS INTEGER) AS batch FROM (
 SELECT e.*, n < 5 AS is_catchall, CASE WHEN n >= 5 THEN zone ELSE rz.zone_r END AS group_zone, CASE WHEN n >= 5 THEN sow ELSE rs.sow_r END AS group_sow FROM ez e JOIN nz USING (entity_id, trade, zone, sow)
 LEFT JOIN (SELECT entity_id, trade, arg_min(zone, (-c, zone)) AS zone_r FROM (SELECT entity_id, trade, zone, sum(n) AS c FROM nz WHERE n < 5 GROUP BY 1, 2, 3) GROUP BY 1, 2) rz USING (entity_id, trade)
 LEFT JOIN (SELECT entity_id, trade, arg_min(sow, (-c, sow)) AS sow_r FROM (SELECT entity_id, trade, sow, sum(n) AS c FROM nz WHERE n < 5 GROUP BY 1, 2, 3) GROUP BY 1, 2) rs USING (entity_id, trade))""", extra="""
ez AS (SELECT event_id, entity_id, trade, CASE event_id % 3 WHEN 0 THEN 'pre_sow' WHEN 1 THEN 'during_sow' ELSE 'post_sow' END AS zone, CASE WHEN days < 20 THEN 'short' ELSE 'long' END AS sow FROM event),
nz AS (SELECT entity_id, trade, zone, sow, count(*) AS n FROM ez GROUP BY 1, 2, 3, 4)"""))
def _(v):
    k = F.col("event_id")
    zone = F.when(k % 3 == 0, "pre_sow").when(k % 3 == 1, "during_sow").otherwise("post_sow")
    df = v.event.select("event_id", "entity_id", "trade", zone.alias("zone"), F.when(F.col("days") < 20, "short").otherwise("long").alias("sow"))
    return gen_events.text_batches(df, ["entity_id"], "event_id").select("event_id", "is_catchall", "group_zone", "group_sow", "batch")


@query("G35_example_retrieval", f"""
WITH pool AS ({pe.POOL_SQL}), cells AS (SELECT c.trade, c.sbu, p.doc_id AS example_id, c.sbu = p.sbu AS is_own FROM (SELECT DISTINCT source AS trade, lang AS sbu FROM documents) c JOIN pool p ON c.trade = p.trade)
SELECT trade, sbu, CAST(r AS INTEGER) AS rank, example_id, is_own FROM (SELECT *, row_number() OVER (PARTITION BY trade, sbu ORDER BY is_own DESC NULLS LAST, {usql(['trade', 'sbu', 'example_id'], 'example')}, example_id) AS r FROM cells) WHERE r <= 12""")
def _(v):
    cells = v.table("documents", "source", "lang").select(F.col("source").alias("trade"), F.col("lang").alias("sbu")).distinct()
    pool = pe.pool(v).select("trade", "sbu", F.col("doc_id").alias("example_id"))
    return gen_events.examples_for(cells, pool, n=12).select("trade", "sbu", "rank", "example_id", "is_own")


NOTES = {k: n.replace("'", "''") for k, n in text.ZONE_NOTES.items()}


@query("G36_batch_context", f"""
SELECT o_orderkey, 'Records wanted: ' || (o_orderkey % 20 + 1) || chr(10) || 'Unit: ' || c_mktsegment || chr(10) || 'Sector: ' || o_orderpriority || chr(10) || 'Size: ' || o_orderstatus || ' (' || format('{{:,}}', CAST(round(o_totalprice) AS BIGINT)) || ' sqft)' || chr(10) ||
 'Region: ' || n_name || chr(10) || 'Trade: ' || c_mktsegment || chr(10) || 'System: ' || c_mktsegment || chr(10) || 'Work package: ' || o_orderpriority || chr(10) || 'Zone: ' || CASE o_orderkey % 2 WHEN 0 THEN 'Pre Sow' ELSE 'During Sow' END || chr(10) ||
 CASE o_orderkey % 2 WHEN 0 THEN '{NOTES["pre_sow"]}' ELSE '{NOTES["during_sow"]}' END || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || 'Near a schedule change: ' || CASE WHEN o_orderkey % 10 = 0 THEN 'major' ELSE 'moderate' END ELSE '' END AS context
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def _(v):
    c = v.table("customer", "c_custkey", "c_mktsegment", "c_nationkey").join(v.table("nation", "n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    o = v.table("orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    o = o.withColumns(
        {
            "n": k % 20 + 1, "zone": F.when(k % 2 == 0, "pre_sow").otherwise("during_sow"), "near": k % 5 == 0,
            "note": F.when(k % 10 == 0, "major"), "system": F.lit(None).cast("string"),
        }
    )
    ctx = text.batch_context(
        "n", "c_mktsegment", "o_orderpriority", "o_orderstatus", F.round("o_totalprice"), "n_name", "c_mktsegment", "system", "o_orderpriority", "zone", near="near", near_note="note"
    )
    return o.select("o_orderkey", ctx.alias("context"))


REPLIES = """
r AS (SELECT p_partkey, p_name, p_type, p_brand, 'Question on ' || p_name || ' fittings' AS subj, 'The ' || p_name || ' does not match the drawing at the level stated.' AS descr FROM part)"""


def cleaned_replies(v):
    p = v.table("part", "p_partkey", "p_name", "p_type", "p_brand")
    k = F.col("p_partkey")
    subj = F.when(k % 5 == 2, F.lit("Too short")).otherwise(F.concat(F.lit("Question on "), "p_name", F.lit(" fittings")))
    descr = F.concat(F.lit("The "), "p_name", F.lit(" does not match the drawing at the level stated."))
    one = F.to_json(F.struct(subj.alias("str_rfi_subject"), descr.alias("str_rfi_description"), F.concat(F.lit("Use detail "), "p_brand").alias("str_rfi_response")))
    raw = (
        F.when(k % 5 == 0, F.concat(F.lit("```json\n["), one, F.lit("]\n```")))
        .when(k % 5 == 1, one)
        .when(k % 5 == 3, F.concat(F.lit("["), one))
        .otherwise(F.concat(F.lit("["), one, F.lit("]")))
    )
    df = p.withColumns({"raw": F.when(k % 5 == 3, F.concat(F.lit("not json "), raw)).otherwise(raw), "wanted": F.lit(2)})
    return text.clean_replies(df, ["p_partkey"], "raw", "wanted", "p_type", "p_brand")


@query("G37_reply_cleaning", "WITH " + REPLIES + """
SELECT p_partkey, position, CASE WHEN good THEN subj ELSE 'Clarification required: ' || p_type || ' — ' || p_brand END AS str_rfi_subject, CASE WHEN good THEN descr ELSE 'A question from the site about ' || p_type || ' work in ' || p_brand || '.' END AS str_rfi_description,
 CASE WHEN good THEN 'Use detail ' || p_brand ELSE 'An answer from the designers is awaited.' END AS str_rfi_response, NOT good AS is_stub
FROM (SELECT *, position = 1 AND p_partkey % 5 <> 3 AND length(descr) >= 40 AND NOT (p_partkey % 5 = 2) AS good FROM (SELECT r.*, CAST(unnest([1, 2]) AS INTEGER) AS position FROM r))""")
def _(v):
    return cleaned_replies(v)


@query("G37_stub_rate", """
SELECT count(*) * 2 AS n_rows, round(sum(CASE WHEN p_partkey % 5 IN (2, 3) OR length('The ' || p_name || ' does not match the drawing at the level stated.') < 40 THEN 2 ELSE 1 END) * 100.0::DOUBLE / (count(*) * 2), 4) AS pct_stub FROM part""")
def _(v):
    return text.stub_rate(cleaned_replies(v))


# budgets


def budget_tables(v):
    led = v.ledger
    return {
        "presence": v.stored("presence", lambda: ledger.division_presence(led, v.project, pl.MANDATORY)),
        "counts": v.stored("code_counts", lambda: ledger.code_counts(led, v.project)),
        "frequency": v.stored("code_frequency", lambda: ledger.code_frequency(led)),
        "mix": v.stored("mix", lambda: collapsed_mix(led.filter("amt_original > 0"), ["division"], "category", "amt_original", "entity_id")),
        "ratios": v.stored("ratios", lambda: ledger.ratio_profile(ledger.amount_ratios(led, v.project))),
        "totals": v.stored("totals", lambda: ledger.total_ratio_profile(led, v.project)),
    }


@query("G38_budget_lines")
def _(v):
    return rounded(gen_budget.lines(entities(v), **budget_tables(v), mandatory=pl.MANDATORY), 4)


CURVE = pl.SCURVE + """,
pf AS (SELECT division, decile, round(quantile_cont(cume_share, 0.5), 6) AS y FROM pts GROUP BY 1, 2 HAVING count(*) >= 3)"""


def interp(x, div, t="pf"):
    a = f"(SELECT max(decile) FROM {t} WHERE {t}.division = {div} AND decile <= {x})"
    b = f"(SELECT min(decile) FROM {t} WHERE {t}.division = {div} AND decile > {x})"
    return a, b


GRIDX = """
gx AS (SELECT division, x / CAST(40 AS DOUBLE) AS x FROM (SELECT DISTINCT division FROM pf), (SELECT unnest(generate_series(0, 40)) AS x)),
g1 AS (SELECT g.division, g.x, max(p.decile) FILTER (WHERE p.decile <= g.x) AS a, min(p.decile) FILTER (WHERE p.decile > g.x) AS b FROM gx g JOIN pf p USING (division) GROUP BY 1, 2),
g2 AS (SELECT g1.division, g1.x, least(CAST(1 AS DOUBLE), CASE WHEN a IS NULL THEN pb.y WHEN b IS NULL THEN pa.y ELSE pa.y + (pb.y - pa.y) * (x - a) / (b - a) END) AS share FROM g1
 LEFT JOIN pf pa ON pa.division = g1.division AND pa.decile = a LEFT JOIN pf pb ON pb.division = g1.division AND pb.decile = b)"""


def curve_profile(v):
    return v.stored("scurve_profile", lambda: ledger.scurve_profile(ledger.scurve_points(v.ledger, v.project), digits=6))


@query("G39_scurve_interpolation", with_("ledger", "project", extra=CURVE + "," + GRIDX, body="SELECT division, x, round(share, 8) AS share FROM g2"))
def _(v):
    df = gen_budget.shapes(curve_profile(v)).withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: i / 40.0)))
    return df.select("division", "x", F.round(gen_budget.interpolate(F.col("curve"), F.col("x")), 8).alias("share"))


WIN = {"Brand#2": (0.25, 0.75), "Brand#3": (0.5, 1.0)}
SHIFT = {"promo": 0.25, "small": -0.125}


@query("G40_monthly_cost", with_("ledger", "project", extra=CURVE + "," + GRIDX + """,
ln AS (SELECT entity_id, division, cost_code, category, sum(amt_original) AS amt FROM ledger GROUP BY 1, 2, 3, 4),
cl AS (SELECT ln.*, m, m / CAST(8 AS DOUBLE) AS x, least(1, greatest(0, m / CAST(8 AS DOUBLE) + CASE category WHEN 'promo' THEN 0.25 WHEN 'small' THEN -0.125 ELSE 0 END)) AS x2 FROM ln, (SELECT unnest(generate_series(0, 8)) AS m)),
sh AS (SELECT cl.*, CASE WHEN cl.division NOT IN ('Brand#2', 'Brand#3') OR (cl.division = 'Brand#2' AND cl.x BETWEEN 0.25 AND 0.75) OR (cl.division = 'Brand#3' AND cl.x BETWEEN 0.5 AND 1) THEN least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), 0.7::DOUBLE * a.share + 0.3::DOUBLE * b.share)) * amt END AS c
 FROM cl JOIN g2 a ON a.division = cl.division AND a.x = cl.x JOIN g2 b ON b.division = cl.division AND b.x = CAST(cl.x2 AS DOUBLE))""", body="""
SELECT entity_id, division, cost_code, category, m AS month, round(coalesce(max(c) OVER (PARTITION BY entity_id, division, cost_code, category ORDER BY m ROWS UNBOUNDED PRECEDING), 0), 3) AS amt_jtd FROM sh"""))
def _(v):
    lines = v.ledger.groupBy("entity_id", "division", "cost_code", "category").agg(F.sum("amt_original").alias("amt_original"))
    months = v.project.select("entity_id", F.explode(F.sequence(F.lit(0), F.lit(8))).alias("month")).withColumn("lifecycle", F.col("month") / 8.0)
    out = gen_budget.monthly_cost(lines, months, gen_budget.shapes(curve_profile(v)), windows=WIN, shifts=SHIFT, mandatory=("Brand#1",))
    return out.select("entity_id", "division", "cost_code", "category", "month", F.round("amt_jtd", 3).alias("amt_jtd"))


@query("G41_output_self_checks", with_("version", body="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE target_date IS NULL) AS n_missing, count(*) FILTER (WHERE effective_from + 90 < effective_from) AS n_reversed,
 (SELECT count(*) FROM (SELECT target_date, lag(target_date) OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS p FROM version) WHERE target_date < p) AS n_falling, (SELECT count(DISTINCT entity_id) FROM version) AS n_entities,
 (SELECT count(*) FROM (SELECT 1 FROM version GROUP BY entity_id HAVING count(*) = 1)) AS n_single_version, (SELECT round(avg(n), 4) FROM (SELECT count(*) AS n FROM version GROUP BY entity_id)) AS avg_versions,
 (SELECT count(*) FROM (SELECT 1 FROM version GROUP BY entity_id HAVING count(*) FILTER (WHERE is_active) <> 1)) AS n_not_one_active FROM version"""))
def _(v):
    df = v.version.select("entity_id", "code", "effective_from", F.date_add("effective_from", 90).alias("effective_to"), F.col("target_date").alias("dt_tco"), "is_active")
    return gen_versions.self_check(df, ["entity_id", "code", "dt_tco", "effective_from"])


@query("G41_work_self_checks")
def _(v):
    return gen_work.self_check(task_records(v))


@query("G9_root_table")
def _(v):
    return gen_entities.generate(real(v), synthetic_size(v))
