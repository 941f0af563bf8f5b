"""Aggregation operators on the test tables."""

from pyspark.sql import functions as F

from sigloom.bindings.registry import query
from sigloom.bindings.views import qd, with_
from sigloom.functions import clean
from sigloom.operators import aggregates as ag
from sigloom.operators.levels import Level, profile_levels, unpivot_fields
from sigloom.operators.quantiles import Stats, exact_quantiles, first_of, group_stats, percents


def rounded(df, digits=6, skip=()):
    """Round the double columns, so that the order of summation does not show."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


ORDER_QS = percents("p5", "p25", "median", "p75", "p95")


@query("A1_basic_group_stats", """
SELECT o_orderpriority AS grp, count(*) AS n, min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean,
 round(stddev_samp(o_totalprice), 4) AS stddev FROM orders GROUP BY 1""")
def _(v):
    o = v.table("orders", "o_orderpriority", "o_totalprice").withColumnRenamed("o_orderpriority", "grp")
    return rounded(group_stats(o, ["grp"], [Stats("o_totalprice", basics=("min", "max", "mean", "stddev"))]), 4)


def q_list(x, names, p=""):
    return ", ".join(qd(x, {**ORDER_QS, **percents("p1", "p10", "p90", "p99")}[n], p + n) for n in names)


@query("A2_approx_quantiles", f"SELECT o_orderpriority AS grp, {q_list('o_totalprice', ORDER_QS)} FROM orders GROUP BY 1")
def _(v):
    o = v.table("orders", "o_orderpriority", "o_totalprice")
    return group_stats(o.withColumnRenamed("o_orderpriority", "grp"), ["grp"], [Stats("o_totalprice", ORDER_QS)]).drop("n")


@query("A3_quantile_array", """
SELECT o_orderpriority AS grp, list_extract(q, 1) AS p25, list_extract(q, 2) AS p50, list_extract(q, 3) AS p75
FROM (SELECT o_orderpriority, quantile_disc(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders GROUP BY 1)""")
def _(v):
    q = F.percentile_approx("o_totalprice", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 100_000).alias("q")
    o = v.table("orders", "o_orderpriority", "o_totalprice").groupBy(F.col("o_orderpriority").alias("grp")).agg(q)
    return o.select("grp", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])


@query("A4_exact_quantiles", """
SELECT c_mktsegment AS grp, count(*) AS n, round(quantile_cont(c_acctbal, 0.1), 6) AS p10, round(quantile_cont(c_acctbal, 0.5), 6) AS median,
 round(quantile_cont(c_acctbal, 0.99), 6) AS p99 FROM customer GROUP BY 1""")
def _(v):
    c = v.table("customer", "c_mktsegment", "c_acctbal").withColumnRenamed("c_mktsegment", "grp")
    return exact_quantiles(c, ["grp"], "c_acctbal", percents("p10", "median", "p99"), min_rows=3, digits=6)


ENTITY_FIELDS = ("duration_days", "n_floors", "gross_area", "amt_contract", "amt_cost")


def entity_fields(v):
    return v.entity.withColumn("duration_days", clean.span_days("dt_start", "dt_end"))


@query("A5_multi_field_profile", with_("entity", body="""
SELECT sbu, field, count(value) AS n, min(value) AS min, quantile_disc(value, 0.5) AS median, max(value) AS max, round(avg(value), 4) AS mean
FROM (UNPIVOT (SELECT sbu, CAST(date_diff('day', dt_start, dt_end) AS DOUBLE) AS duration_days, CAST(n_floors AS DOUBLE) AS n_floors, gross_area, amt_contract, amt_cost FROM entity)
 ON duration_days, n_floors, gross_area, amt_contract, amt_cost INTO NAME field VALUE value) GROUP BY 1, 2"""))
def _(v):
    long = unpivot_fields(entity_fields(v), ["sbu"], ENTITY_FIELDS).filter("value IS NOT NULL")
    return rounded(group_stats(long, ["sbu", "field"], [Stats("value", {"median": 0.5}, ("min", "max", "mean"))]), 4)


FULL = ("p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99")
SHORT = ("p5", "p10", "p25", "median", "p75", "p90", "p95")


@query("A6_full_percentile_profile", with_("project", body=f"""
SELECT sbu, size_category, count(*) AS n_projects, {q_list('n_orders', FULL)}, min(n_orders) AS min, max(n_orders) AS max, round(avg(n_orders), 6) AS mean,
 round(stddev_samp(n_orders), 6) AS stddev FROM project GROUP BY 1, 2 HAVING count(*) >= 40"""))
def _(v):
    st = Stats("n_orders", percents(*FULL), ("min", "max", "mean", "stddev"))
    return rounded(group_stats(v.project, ["sbu", "size_category"], [st], count="n_projects", min_rows=40))


@query("A7_short_percentile_profile", with_("task", body=f"""
SELECT sow, count(*) AS n_observations, {q_list('target', SHORT)}, round(avg(target), 6) AS mean, min(target) AS min, max(target) AS max
FROM task WHERE sow IS NOT NULL GROUP BY 1 HAVING count(*) >= 10"""))
def _(v):
    st = Stats("target", percents(*SHORT), ("mean", "min", "max"))
    return rounded(group_stats(v.task.filter("sow IS NOT NULL"), ["sow"], [st], count="n_observations", min_rows=10))


SEQ_EXTRA = """
w AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY s, sow) AS seq FROM
 (SELECT entity_id, sow, min(task_start) s, max(task_end) f FROM task WHERE sow IS NOT NULL GROUP BY 1, 2))"""


def work_sequence(v):
    from sigloom.plans.work import sequence, windows

    return sequence(windows(v.task, "entity_id", "sow", "task_start", "task_end"), "entity_id", "sow")


@query("A8_sequence_profile", with_("task", body=f"""
SELECT sow, count(*) AS n_occurrences, count(DISTINCT entity_id) AS n_projects, {q_list('seq', ('p10', 'p25', 'median', 'p75', 'p90'))},
 round(avg(seq), 6) AS mean, round(stddev_samp(seq), 6) AS stddev, min(seq) AS min, max(seq) AS max FROM w GROUP BY 1 HAVING count(DISTINCT entity_id) >= 10""", extra=SEQ_EXTRA))
def _(v):
    st = Stats("seq", percents("p10", "p25", "median", "p75", "p90"), ("mean", "stddev", "min", "max"))
    extra = {"n_projects": F.count_if("first")}
    seq = work_sequence(v).withColumn("first", first_of(["sow"], "entity_id"))
    return rounded(group_stats(seq, ["sow"], [st], count="n_occurrences", extra=extra, min_rows=10, min_on="n_projects"))


@query("A9_two_measure_profile", with_("project", body=f"""
SELECT sbu, count(*) AS n_projects, {q_list('n_orders', ('p25', 'median', 'p75'), 'orders_')}, round(avg(n_orders), 6) AS orders_mean,
 {q_list('gross_area', ('p25', 'median', 'p75'), 'area_')}, round(avg(gross_area), 6) AS area_mean FROM project GROUP BY 1"""))
def _(v):
    three = percents("p25", "median", "p75")
    st = [Stats("n_orders", three, ("mean",), prefix="orders_"), Stats("gross_area", three, ("mean",), prefix="area_")]
    return rounded(group_stats(v.project, ["sbu"], st, count="n_projects"))


@query("A10_milestone_offsets", with_("entity", body=f"""
SELECT sbu, field, count(*) AS n, min(value) AS min, {q_list('value', ('p25', 'median', 'p75'))}, max(value) AS max, round(avg(value), 6) AS mean FROM (
 SELECT sbu, 'start_to_end' AS field, date_diff('day', dt_start, dt_end) AS value FROM entity
 UNION ALL SELECT sbu, 'end_to_cutoff', date_diff('day', dt_end, DATE '2000-01-01') FROM entity) WHERE value >= 0 GROUP BY 1, 2"""))
def _(v):
    from sigloom.plans.versions import milestone_profile

    df = v.entity.withColumns(
        {"start_to_end": F.datediff("dt_end", "dt_start"), "end_to_cutoff": F.datediff(F.lit("2000-01-01").cast("date"), "dt_end")}
    )
    out = milestone_profile(df, [Level("SBU", ("sbu",))], ["start_to_end", "end_to_cutoff"], ("p25", "median", "p75"), ("min", "max", "mean"))
    return rounded(out.drop("level")).select(
        "sbu", "field", "n", *[F.col(c).cast("int").alias(c) for c in ("min", "p25", "median", "p75", "max")], "mean"
    )


MULTI = ("p25", "median", "p75")


def level_sql(level, dims, keys, table, x, having=0, names=MULTI):
    cols = ", ".join(d if d in keys else f"NULL AS {d}" for d in dims)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    hv = f"HAVING count(*) >= {having}" if having else ""
    return f"SELECT '{level}' AS level, {cols}, count(*) AS n, {q_list(x, names)}, round(avg({x}), 6) AS mean FROM {table} {group} {hv}"


DIMS = ("sbu", "size_category", "contract_bucket", "asset")
A11 = [("SBU", ("sbu",), 0), ("SBU_SIZE", ("sbu", "size_category"), 30), ("SBU_CONTRACT", ("sbu", "contract_bucket"), 30),
       ("SBU_ASSET", ("sbu", "asset"), 60), ("GLOBAL", (), 0)]


@query("A11_multi_level_profile", with_("project", body=" UNION ALL ".join(level_sql(n, DIMS, k, "project", "n_orders", h) for n, k, h in A11)))
def _(v):
    levels = [Level(n, k, h) for n, k, h in A11]
    return rounded(profile_levels(v.project, levels, [Stats("n_orders", percents(*MULTI), ("mean",))]))


@query("A12_having_group_size", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 HAVING count(*) >= 85")
def _(v):
    return group_stats(v.table("part", "p_brand"), ["p_brand"], [], min_rows=85)


@query("A13_distinct_count", with_("ledger", body="SELECT division, count(DISTINCT entity_id) AS n_entities, count(DISTINCT cost_code) AS n_codes FROM ledger GROUP BY 1"))
def _(v):
    return v.ledger.groupBy("division").agg(F.count_distinct("entity_id").alias("n_entities"), F.count_distinct("cost_code").alias("n_codes"))


@query("A14_dedup_rows", with_("task", body="""
SELECT entity_id, sow, task_code FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, sow ORDER BY task_start, task_code) rn FROM task WHERE sow IS NOT NULL) WHERE rn = 1"""))
def _(v):
    t = v.task.filter("sow IS NOT NULL").select("entity_id", "sow", "task_start", "task_code")
    return ag.dedup(t, ["entity_id", "sow"], ["task_start", "task_code"]).select("entity_id", "sow", "task_code")


@query("A15_conditional_percent", with_("task", body="""
SELECT sow, count(*) AS n, count(*) FILTER (WHERE start_source = 'early start') AS n_early,
 round(count(*) FILTER (WHERE start_source = 'early start') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_early FROM task GROUP BY 1"""))
def _(v):
    early = F.count_if(F.col("start_source") == "early start")
    return v.task.groupBy("sow").agg(F.count(F.lit(1)).alias("n"), early.alias("n_early"), F.round(early * 100.0 / F.count(F.lit(1)), 4).alias("pct_early"))


@query("A16_conditional_max_flag", with_("ledger", body="""
SELECT entity_id, max(CASE WHEN pending_in > 0 THEN 1 ELSE 0 END) AS has_in, max(CASE WHEN pending_out < 0 THEN 1 ELSE 0 END) AS has_out FROM ledger GROUP BY 1"""))
def _(v):
    return v.ledger.groupBy("entity_id").agg(
        ag.flag_if_any(F.col("pending_in") > 0).alias("has_in"), ag.flag_if_any(F.col("pending_out") < 0).alias("has_out")
    )


@query("A17_first_value", with_("version", body="""
SELECT entity_id, first_code, effective_from, last_target FROM (SELECT entity_id, first_value(code) OVER w AS first_code, min(effective_from) OVER (PARTITION BY entity_id) AS effective_from,
 max(target_date) OVER (PARTITION BY entity_id) AS last_target, row_number() OVER w AS rn FROM version WINDOW w AS (PARTITION BY entity_id ORDER BY effective_from, code)) WHERE rn = 1"""))
def _(v):
    first = ag.first_by(["code"], ["effective_from", "code"])["code"]
    return v.version.groupBy("entity_id").agg(first.alias("first_code"), F.min("effective_from").alias("effective_from"), F.max("target_date").alias("last_target"))


@query("A18_latest_rows", with_("ledger", body="""
SELECT entity_id, division, dt_budget, amt_original FROM (SELECT *, max(dt_budget) OVER (PARTITION BY entity_id, division) AS m FROM ledger) WHERE dt_budget = m"""))
def _(v):
    return ag.latest_rows(v.ledger.select("entity_id", "division", "dt_budget", "amt_original"), ["entity_id", "division"], "dt_budget")


@query("A19_sum_then_ratio", with_("ledger", "project", body="""
SELECT l.entity_id, l.division, round(l.amt / p.amt_contract, 8) AS ratio FROM (SELECT entity_id, division, sum(amt_original) AS amt FROM ledger GROUP BY 1, 2) l JOIN project p USING (entity_id)"""))
def _(v):
    amt = v.ledger.groupBy("entity_id", "division").agg(F.sum("amt_original").alias("amt"))
    df = amt.join(v.project.select("entity_id", "amt_contract"), "entity_id")
    return df.select("entity_id", "division", F.round(clean.ratio("amt", "amt_contract"), 8).alias("ratio"))


@query("A20_presence_probability", with_("ledger", "project", body="""
SELECT sbu, division, n_with, n_total, round(n_with / CAST(n_total AS DOUBLE), 4) AS presence_prob, division IN ('Brand#1', 'Brand#25') AS is_mandatory
FROM (SELECT sbu, division, count(DISTINCT entity_id) AS n_with FROM ledger JOIN project USING (entity_id) GROUP BY 1, 2)
JOIN (SELECT sbu, count(*) AS n_total FROM project GROUP BY 1) USING (sbu)"""))
def _(v):
    p = v.project.select("entity_id", "sbu")
    pairs = v.ledger.select("entity_id", "division").distinct().join(p, "entity_id")
    return ag.presence(pairs, p, "entity_id", "division", "sbu", mandatory=("Brand#1", "Brand#25"))


@query("A21_frequency_json", with_("ledger", body="""
SELECT division, CAST((rn - 1) // 20 AS INTEGER) AS part, max(n) AS n_max,
 '[' || string_agg('{"item":' || cost_code || ',"n":' || n || '}', ',' ORDER BY rn) || ']' AS json_blob
FROM (SELECT *, row_number() OVER (PARTITION BY division ORDER BY n DESC, cost_code) AS rn FROM
 (SELECT division, cost_code, count(DISTINCT entity_id) AS n FROM ledger GROUP BY 1, 2)) GROUP BY 1, 2"""))
def _(v):
    freq = ag.frequency(v.ledger, ["division"], "cost_code", "entity_id", "n")
    return ag.frequency_json(freq, ["division"], "cost_code", "n", chunk=20)


def mix_sql(min_w, min_n):
    return f"""
cell AS (SELECT division, category, sum(amt_original) AS amt, count(DISTINCT entity_id) AS n_e FROM ledger WHERE amt_original > 0 GROUP BY 1, 2),
wt AS (SELECT *, amt / sum(amt) OVER (PARTITION BY division) AS w FROM cell),
kept AS (SELECT *, w >= {min_w} AND n_e >= {min_n} AS keep FROM wt),
mix AS (SELECT division, category, round((w + (sa - sk) * w / sk) / sa, 4) AS weight FROM (SELECT *, sum(w) FILTER (WHERE keep) OVER (PARTITION BY division) AS sk, sum(w) OVER (PARTITION BY division) AS sa FROM kept) WHERE keep
 UNION ALL SELECT division, 'other', CAST(1 AS DOUBLE) FROM kept GROUP BY division HAVING NOT bool_or(keep))"""


@query("A22_collapsed_mix", with_("ledger", body="SELECT * FROM mix", extra=mix_sql("CAST(0.172 AS DOUBLE)", 200)))
def _(v):
    return ag.collapsed_mix(v.ledger.filter("amt_original > 0"), ["division"], "category", "amt_original", "entity_id", 0.172, 200)


@query("A23_pivot_shares", with_("task", body="""
SELECT sow, CASE WHEN count(*) FILTER (WHERE s = 'completed') > 0 THEN round(count(*) FILTER (WHERE s = 'completed') * CAST(100 AS DOUBLE) / count(*), 4) END AS pct_completed,
 CASE WHEN count(*) FILTER (WHERE s = 'active') > 0 THEN round(count(*) FILTER (WHERE s = 'active') * CAST(100 AS DOUBLE) / count(*), 4) END AS pct_active,
 CASE WHEN count(*) FILTER (WHERE s = 'paused') > 0 THEN round(count(*) FILTER (WHERE s = 'paused') * CAST(100 AS DOUBLE) / count(*), 4) END AS pct_paused
FROM (SELECT sow, CASE WHEN remaining = 0 THEN 'completed' WHEN remaining = target THEN 'not_started' ELSE 'active' END AS s FROM task) GROUP BY 1"""))
def _(v):
    from sigloom.functions.buckets import completion_status

    df = v.task.select("sow", completion_status("remaining", "target").alias("s"))
    return ag.pivot_shares(df, "sow", "s", ["completed", "active", "paused"], digits=4)


@query("A24_mode_with_fallback", with_("entity", body="""
SELECT s.sbu, coalesce(m.asset, g.asset) AS mode FROM (SELECT DISTINCT sbu FROM entity) s LEFT JOIN
 (SELECT sbu, asset FROM (SELECT sbu, asset, row_number() OVER (PARTITION BY sbu ORDER BY count(*) DESC, asset) rn FROM entity WHERE asset IS NOT NULL AND sbu <> 'BUILDING' GROUP BY 1, 2) WHERE rn = 1) m USING (sbu),
 (SELECT asset FROM entity WHERE sbu <> 'BUILDING' GROUP BY 1 ORDER BY count(*) DESC, asset LIMIT 1) g"""))
def _(v):
    df = v.entity.select("sbu", F.when(F.col("sbu") != "BUILDING", F.col("asset")).alias("asset"))
    return ag.mode_by_group(df, "sbu", "asset")


@query("A25_pmf", with_("entity", body="""
SELECT sbu, n_floors, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY sbu) AS DOUBLE), 6) AS prob FROM entity WHERE n_floors IS NOT NULL GROUP BY 1, 2"""))
def _(v):
    return ag.pmf(v.entity, ["sbu"], "n_floors")


@query("A26_quartile_triples", with_("entity", body="""
SELECT 'SBU_ASSET' AS level, sbu, asset, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.25), 6) AS p25, round(quantile_cont(x, 0.75), 6) AS p75 FROM r GROUP BY 2, 3
UNION ALL SELECT 'SBU', sbu, NULL, round(quantile_cont(x, 0.5), 6), round(quantile_cont(x, 0.25), 6), round(quantile_cont(x, 0.75), 6) FROM r GROUP BY sbu""", extra="""
r AS (SELECT sbu, asset, gross_area / n_floors AS x FROM entity WHERE gross_area > 0 AND n_floors > 0)"""))
def _(v):
    from sigloom.operators.setops import union_all

    r = v.entity.filter("gross_area > 0 AND n_floors > 0").select("sbu", "asset", (F.col("gross_area") / F.col("n_floors")).alias("x"))
    qs = percents("median", "p25", "p75")
    out = [
        exact_quantiles(r, keys, "x", qs, digits=6).withColumn("level", F.lit(name))
        for name, keys in (("SBU_ASSET", ["sbu", "asset"]), ("SBU", ["sbu"]))
    ]
    return union_all(out).select("level", "sbu", "asset", *qs)


@query("A27_quota_allocation", """
SELECT n_name, n_real, CAST(CASE WHEN n_name = big THEN q + 1000 - sum(q) OVER () + coalesce(sum(CASE WHEN tiny THEN q END) OVER (), 0) WHEN tiny THEN 0 ELSE q END AS INTEGER) AS quota
FROM (SELECT *, first_value(n_name) OVER (ORDER BY n_real DESC, n_name) AS big FROM (SELECT n_name, count(*) AS n_real, round(count(*) / CAST((SELECT count(*) FROM customer) AS DOUBLE) * 1000) AS q, count(*) < 50 AS tiny
 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1))""")
def _(v):
    n = v.table("nation", "n_nationkey", "n_name")
    df = v.table("customer", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return ag.quotas(df, "n_name", 1000, too_small=50)


BOUND_NAMES = ("p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99")


def json_of(names, quote_double=True):
    """JSON map text with doubles as Spark prints them."""
    parts = [f"""'"{k}":' || coalesce(CAST(CAST({c} AS DOUBLE) AS VARCHAR), 'null')""" for k, c in names]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


BOUND_MAP = [("min", "min"), *[("p50" if n == "median" else n, n) for n in BOUND_NAMES], ("max", "max")]


@query("A28_constraint_rows", with_("entity", body=f"""
SELECT level, sbu, asset, field, n, {json_of(BOUND_MAP)} AS bounds_json FROM (
 SELECT 'SBU' AS level, sbu, NULL AS asset, 'gross_area' AS field, count(*) AS n, min(gross_area) AS min, {q_list('gross_area', BOUND_NAMES)}, max(gross_area) AS max FROM entity GROUP BY sbu
 UNION ALL SELECT 'SBU_ASSET', sbu, asset, 'gross_area', count(*), min(gross_area), {q_list('gross_area', BOUND_NAMES)}, max(gross_area) FROM entity GROUP BY sbu, asset)"""))
def _(v):
    from sigloom.plans.entity import bounds

    return bounds(v.entity, [Level("SBU", ("sbu",)), Level("SBU_ASSET", ("sbu", "asset"), 5)], ["gross_area"]).select("level", "sbu", "asset", "field", "n", "bounds_json")


@query("A29_bounds_map", f"""
SELECT event_type AS trade, {json_of([('p25', 'p25'), ('median', 'median'), ('spare', 'spare')])} AS bounds_json FROM (SELECT event_type, quantile_disc(value, 0.25) AS p25, quantile_disc(value, 0.5) AS median, CAST(NULL AS DOUBLE) AS spare FROM events GROUP BY 1)""")
def _(v):
    st = group_stats(v.event, ["trade"], [Stats("days", percents("p25", "median"))]).withColumn("spare", F.lit(None).cast("double"))
    return st.select("trade", ag.bounds_json(["p25", "median", "spare"]).alias("bounds_json"))


@query("A30_rollup_summary", with_("entity", body="SELECT sbu, asset, count(*) AS n FROM entity GROUP BY ROLLUP (sbu, asset)"))
def _(v):
    return v.entity.rollup("sbu", "asset").agg(F.count(F.lit(1)).alias("n")).orderBy("sbu", "asset")


@query("A31_global_aggregate", with_("event", body=f"SELECT count(*) AS n, {q_list('days', ('p25', 'median', 'p75'))}, round(avg(days), 6) AS mean FROM event"))
def _(v):
    return rounded(group_stats(v.event, [], [Stats("days", percents("p25", "median", "p75"), ("mean",))]))
