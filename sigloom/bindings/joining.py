"""Sources, joins, lookups and set operators on the test tables."""


import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.operators import joins, setops
from sigloom.operators.aggregates import best_duplicate, bounds_json
from sigloom.operators.levels import Level, profile_levels
from sigloom.operators.lookup import fallback, fallback_bounds, pair_or_general
from sigloom.operators.quantiles import Stats, percents
from sigloom.session import ensure_checkpoint_dir
from sigloom.sources import tables


# sources


@query("S1_table_scan", "SELECT * FROM nation")
def _(v):
    return tables.scan(v.spark, f"{v.sf_dir}/nation.parquet")


@query("S2_projected_scan", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 400000")
def _(v):
    df = tables.scan(v.spark, f"{v.sf_dir}/orders.parquet", ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return df.filter("o_totalprice > 400000").select("o_orderkey", "o_orderpriority")


@query("S3_optional_scan", """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'no_such_table', NULL""")
def _(v):
    parts = []
    for name in ("orders", "no_such_table"):
        df = tables.optional_scan(v.spark, f"{v.sf_dir}/{name}.parquet")
        n = F.count(F.lit(1)).alias("n_rows")
        parts.append(
            df.agg(n).select(F.lit(name).alias("table_name"), "n_rows")
            if df is not None
            else v.spark.range(1).select(F.lit(name).alias("table_name"), F.lit(None).cast("long").alias("n_rows"))
        )
    return setops.union_all(parts)


@query("S4_sql_source", """
WITH big AS (SELECT o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000)
SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS amt FROM big JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def _(v):
    text = """
    WITH big AS (SELECT o_custkey, o_totalprice FROM {orders} WHERE o_totalprice > 300000)
    SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS amt
    FROM big JOIN {customer} ON o_custkey = c_custkey GROUP BY 1"""
    return tables.sql_source(v.spark, text, orders=v.table("orders"), customer=v.table("customer"))


@query("S8_resume_not_done", """
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1997-01-01')""")
def _(v):
    done = v.table("orders", "o_custkey", "o_orderdate").filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    done = done.select(F.col("o_custkey").alias("c_custkey"))
    return tables.not_done(v.table("customer", "c_custkey", "c_name"), done, "c_custkey")


def shared_folder(v, name):
    """A new folder below the shared checkpoint folder for a written table."""
    return f"{ensure_checkpoint_dir(v.spark).rstrip('/')}/sigloom-{name}-{uuid.uuid4().hex}"


SEGMENTS = "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1"


def segments(v):
    return v.table("customer", "c_mktsegment").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("S5_overwrite_new_schema", "SELECT c_mktsegment, count(*) AS n, 'v2' AS run FROM customer GROUP BY 1")
def _(v):
    where = shared_folder(v, "s5")
    tables.overwrite(segments(v).withColumn("old_column", F.lit(1)), where)
    tables.overwrite(segments(v).withColumn("run", F.lit("v2")), where)
    return tables.scan(v.spark, where)


@query("S6_overwrite_same_schema", SEGMENTS)
def _(v):
    where = shared_folder(v, "s6")
    for _i in range(2):
        tables.overwrite(segments(v), where, keep_schema=True)
    return tables.scan(v.spark, where)


@query("S7_append_schema_merge", """
SELECT c_mktsegment, n, CAST(NULL AS BIGINT) AS n_negative FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)
UNION ALL SELECT c_mktsegment, count(*), count(*) FILTER (WHERE c_acctbal < 0) FROM customer GROUP BY 1""")
def _(v):
    where = shared_folder(v, "s7")
    tables.append(segments(v), where)
    wider = v.table("customer", "c_mktsegment", "c_acctbal").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative")
    )
    tables.append(wider, where)
    return tables.merged_scan(v.spark, where)


@query("S9_incremental_flush", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(v):
    where = shared_folder(v, "s9")
    per = v.table("orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    half = per.filter(F.pmod("o_custkey", F.lit(2)) == 0)
    tables.flush(half, where, "o_custkey", every=2_000_000)
    tables.flush(per, where, "o_custkey", every=2_000_000)  # resumes: writes the other half only
    return tables.scan(v.spark, where)


@query("S10_multi_table_output", """
SELECT 'segment' AS output, c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def _(v):
    where = shared_folder(v, "s10")
    frames = {
        "segment": segments(v).withColumnRenamed("c_mktsegment", "name"),
        "priority": v.table("orders", "o_orderpriority").groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("n")),
    }
    tables.write_all(frames, lambda n: f"{where}/{n}")
    return setops.union_all([tables.scan(v.spark, f"{where}/{n}").withColumn("output", F.lit(n)) for n in frames])


@query("S11_pinned_base", """
SELECT o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY 1""")
def _(v):
    base = tables.pinned(v.table("orders", "o_orderstatus", "o_orderpriority"))
    return setops.union_all([base.groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n")) for c in ("o_orderstatus", "o_orderpriority")])


@query("S12_constant_rows", """
SELECT o_orderkey, w.weight FROM orders JOIN (VALUES ('O', CAST(1.0 AS DOUBLE)), ('F', CAST(0.5 AS DOUBLE))) w(st, weight) ON o_orderstatus = w.st""")
def _(v):
    w = tables.constants(v.spark, [("O", 1.0), ("F", 0.5)], "o_orderstatus string, weight double")
    return v.table("orders", "o_orderkey", "o_orderstatus").join(w, "o_orderstatus").select("o_orderkey", "weight")


# joins


@query("J1_inner_join", "SELECT o_orderkey, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def _(v):
    c = v.table("customer", "c_custkey", "c_mktsegment")
    return v.table("orders", "o_orderkey", "o_custkey", "o_totalprice").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_mktsegment", "o_totalprice"
    )


@query("J2_composite_key_join", with_("task", body="""
SELECT t.task_code, t.task_start, date_diff('day', s.sow_start, t.task_start) AS days_in FROM task t
JOIN (SELECT entity_id, sow, min(task_start) AS sow_start FROM task WHERE sow IS NOT NULL GROUP BY 1, 2) s USING (entity_id, sow)"""))
def _(v):
    t = v.task.filter(F.col("sow").isNotNull())
    s = t.groupBy("entity_id", "sow").agg(F.min("task_start").alias("sow_start"))
    return t.join(s, ["entity_id", "sow"]).select("task_code", "task_start", F.datediff("task_start", "sow_start").alias("days_in"))


@query("J3_keep_large_groups", """
SELECT c_custkey, c_mktsegment, c_nationkey FROM customer JOIN (SELECT c_mktsegment, c_nationkey FROM customer GROUP BY 1, 2 HAVING count(*) >= 13) USING (c_mktsegment, c_nationkey)""")
def _(v):
    c = v.table("customer", "c_custkey", "c_mktsegment", "c_nationkey")
    return joins.keep_large_groups(c, ["c_mktsegment", "c_nationkey"], 13)


@query("J4_totals_left_stats", """
SELECT c_custkey, coalesce(n_open, 0) AS n_open, coalesce(amt_open, CAST(0 AS DOUBLE)) AS amt_open FROM customer LEFT JOIN
 (SELECT o_custkey, count(*) n_open, round(sum(o_totalprice), 2) amt_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) ON o_custkey = c_custkey""")
def _(v):
    stats = (
        v.table("orders", "o_custkey", "o_orderstatus", "o_totalprice").filter("o_orderstatus = 'O'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_open"), F.round(F.sum("o_totalprice"), 2).alias("amt_open"))
    )
    return joins.totals_with_stats(v.table("customer", "c_custkey"), stats, ["c_custkey"], ["n_open", "amt_open"])


@query("J5_orphans", """
SELECT o_custkey, count(*) AS n_rows FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) GROUP BY 1""")
def _(v):
    parent = v.table("customer", "c_custkey", "c_acctbal").filter("c_acctbal > 0")
    return joins.orphan_counts(v.table("orders", "o_custkey"), parent, "o_custkey", "c_custkey")


@query("J6_reconcile_counts", """
SELECT coalesce(a.k, b.k) AS k, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, coalesce(n_a, 0) = coalesce(n_b, 0) AS is_match
FROM (SELECT o_custkey k, count(*) n_a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
FULL JOIN (SELECT o_custkey k, count(*) n_b FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.k = b.k""")
def _(v):
    o = v.table("orders", "o_custkey", "o_orderstatus").withColumnRenamed("o_custkey", "k")
    a = o.filter("o_orderstatus = 'F'").groupBy("k").agg(F.count(F.lit(1)).alias("n_a"))
    b = o.filter("o_orderstatus = 'O'").groupBy("k").agg(F.count(F.lit(1)).alias("n_b"))
    return joins.reconcile_counts(a, b, "k")


@query("J7_share_of_group", with_("event_full", body="""
SELECT sbu, trade, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY sbu), 4) AS pct FROM event_full GROUP BY 1, 2"""))
def _(v):
    n = v.event_full.groupBy("sbu", "trade").agg(F.count(F.lit(1)).alias("n"))
    return joins.share_of_group(n, ["sbu"], "n", "pct")


@query("J8_share_of_all", """
SELECT event_type AS trade, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM events), 4) AS pct FROM events GROUP BY 1""")
def _(v):
    return joins.share_of_all(v.event.groupBy("trade").agg(F.count(F.lit(1)).alias("n")), "n", "pct")


@query("J9_consecutive_pairs", with_("task", body="""
SELECT a.entity_id, a.sow AS sow_first, b.sow AS sow_second, date_diff('day', b.s, a.f) AS overlap_days
FROM w a JOIN w b ON a.entity_id = b.entity_id AND b.seq = a.seq + 1""", extra="""
w AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY s, sow) AS seq FROM
 (SELECT entity_id, sow, min(task_start) s, max(task_end) f FROM task WHERE sow IS NOT NULL GROUP BY 1, 2))"""))
def _(v):
    t = v.task.filter(F.col("sow").isNotNull())
    s = t.groupBy("entity_id", "sow").agg(F.min("task_start").alias("s"), F.max("task_end").alias("f"))
    w = W.partitionBy("entity_id").orderBy("s", "sow")  # one row per work package of an entity
    nxt = F.lead(F.struct("sow", "s")).over(w)
    return s.withColumn("nxt", nxt).filter("nxt IS NOT NULL").select(
        "entity_id", F.col("sow").alias("sow_first"), F.col("nxt.sow").alias("sow_second"), F.datediff("f", "nxt.s").alias("overlap_days")
    )


@query("J10_spine_in_interval", with_("task", body="""
SELECT sp.entity_id, sp.d AS spine_day, count(w.sow) AS n_active FROM sp LEFT JOIN w ON w.entity_id = sp.entity_id AND sp.d BETWEEN w.s AND w.f GROUP BY 1, 2""", extra="""
w AS (SELECT entity_id, sow, min(task_start) s, max(task_end) f FROM task WHERE sow IS NOT NULL GROUP BY 1, 2),
sp AS (SELECT entity_id, CAST(unnest(generate_series(lo, hi, INTERVAL 28 DAY)) AS DATE) AS d FROM (SELECT entity_id, min(s) lo, max(f) hi FROM w GROUP BY 1))"""))
def _(v):
    t = v.task.filter(F.col("sow").isNotNull())
    s = t.groupBy("entity_id", "sow").agg(F.min("task_start").alias("s"), F.max("task_end").alias("f"))
    return joins.active_on_spine(s, "entity_id", "s", "f", step_days=28)


@query("J11_next_snapshot", with_("task", body="""
SELECT s1.entity_id, s1.sow, s1.effective_from, s2.effective_from AS next_from, date_diff('day', s1.f, s2.f) AS finish_shift
FROM snap s1 JOIN snap s2 ON s1.entity_id = s2.entity_id AND s1.sow = s2.sow AND s2.effective_from > s1.effective_from
WHERE NOT EXISTS (SELECT 1 FROM snap s3 WHERE s3.entity_id = s1.entity_id AND s3.sow = s1.sow
  AND s3.effective_from > s1.effective_from AND s3.effective_from < s2.effective_from)""", extra="""
snap AS (SELECT entity_id, sow, effective_from, max(task_end) f FROM task WHERE sow IS NOT NULL GROUP BY 1, 2, 3)"""))
def _(v):
    t = v.task.filter(F.col("sow").isNotNull())
    snap = t.groupBy("entity_id", "sow", "effective_from").agg(F.max("task_end").alias("f"))
    # at most one row per day and work package, so the chain of one key is bounded
    nxt = F.lead(F.struct("effective_from", "f")).over(W.partitionBy("entity_id", "sow").orderBy("effective_from"))
    return snap.withColumn("nxt", nxt).filter("nxt IS NOT NULL").select(
        "entity_id", "sow", "effective_from", F.col("nxt.effective_from").alias("next_from"), F.datediff("nxt.f", "f").alias("finish_shift")
    )


EVENT_DAYS = """
ev AS (SELECT entity_id, created AS day, count(*) AS n FROM event WHERE trade <> 'error' GROUP BY 1, 2),
an AS (SELECT entity_id, created AS day, count(*) AS n FROM event WHERE trade = 'error' GROUP BY 1, 2)"""


def event_days(v):
    ev = joins.daily_counts(v.event.filter("trade <> 'error'"), "entity_id", F.col("created"))
    an = joins.daily_counts(v.event.filter("trade = 'error'"), "entity_id", F.col("created"))
    return ev, an


@query("J12_event_window_join", with_("event", body="""
SELECT an.entity_id, an.day, an.n AS n_anchor,
 coalesce((SELECT sum(e.n) FROM ev e WHERE e.entity_id = an.entity_id AND e.day BETWEEN an.day - 6 AND an.day - 4), 0) AS n_before,
 coalesce((SELECT sum(e.n) FROM ev e WHERE e.entity_id = an.entity_id AND e.day BETWEEN an.day AND an.day + 3), 0) AS n_after FROM an""", extra=EVENT_DAYS))
def _(v):
    ev, an = event_days(v)
    return joins.window_counts(ev, an, "entity_id", {"n_before": (-6, -4), "n_after": (0, 3)})


@query("J13_nearest_event", with_("event", body="""
SELECT ev.entity_id, ev.day, (SELECT min(abs(date_diff('day', a.day, ev.day))) FROM an a WHERE a.entity_id = ev.entity_id) AS min_days FROM ev""", extra=EVENT_DAYS))
def _(v):
    ev, an = event_days(v)
    return joins.nearest_distance(ev, an, "entity_id")


@query("J14_own_version_join", with_("version", "task", body="""
SELECT task_code, t.task_start, date_diff('day', t.task_end, v.target_date) AS days_left FROM task t JOIN version v ON t.code = v.code"""))
def _(v):
    ver = v.version.select("code", "target_date")
    return v.task.join(ver, "code").select("task_code", "task_start", F.datediff("target_date", "task_end").alias("days_left"))


LEVELS = [
    Level("SBU", ("sbu",)), Level("SBU_SIZE", ("sbu", "size_category"), 30), Level("SBU_CONTRACT", ("sbu", "contract_bucket"), 30),
    Level("SBU_ASSET", ("sbu", "asset"), 5), Level("GLOBAL", ()),
]


def order_count_profile(v):
    p = profile_levels(v.project, LEVELS, [Stats("n_orders", percents("p25", "median", "p75"))])
    return p.withColumn("field", F.lit("n_orders"))


PROFILE_SQL = """
prof AS (
 SELECT 'SBU_CONTRACT' AS level, sbu, contract_bucket, NULL AS size_category, NULL AS asset, count(*) AS n, quantile_disc(n_orders, 0.25) AS p25, quantile_disc(n_orders, 0.5) AS median, quantile_disc(n_orders, 0.75) AS p75 FROM project GROUP BY 2, 3 HAVING count(*) >= 30
 UNION ALL SELECT 'SBU_SIZE', sbu, NULL, size_category, NULL, count(*), quantile_disc(n_orders, 0.25), quantile_disc(n_orders, 0.5), quantile_disc(n_orders, 0.75) FROM project GROUP BY sbu, size_category HAVING count(*) >= 30
 UNION ALL SELECT 'SBU_ASSET', sbu, NULL, NULL, asset, count(*), quantile_disc(n_orders, 0.25), quantile_disc(n_orders, 0.5), quantile_disc(n_orders, 0.75) FROM project GROUP BY sbu, asset HAVING count(*) >= 5
 UNION ALL SELECT 'SBU', sbu, NULL, NULL, NULL, count(*), quantile_disc(n_orders, 0.25), quantile_disc(n_orders, 0.5), quantile_disc(n_orders, 0.75) FROM project GROUP BY sbu
 UNION ALL SELECT 'GLOBAL', NULL, NULL, NULL, NULL, count(*), quantile_disc(n_orders, 0.25), quantile_disc(n_orders, 0.5), quantile_disc(n_orders, 0.75) FROM project)"""

FALLBACK_FROM = """
FROM project p
LEFT JOIN prof a ON a.level = 'SBU_CONTRACT' AND a.n >= {n} AND a.sbu = p.sbu AND a.contract_bucket = p.contract_bucket
LEFT JOIN prof b ON b.level = 'SBU_SIZE' AND b.n >= {n} AND b.sbu = p.sbu AND b.size_category = p.size_category
LEFT JOIN prof c ON c.level = 'SBU_ASSET' AND c.n >= {n} AND c.sbu = p.sbu AND c.asset = p.asset
LEFT JOIN prof d ON d.level = 'SBU' AND d.sbu = p.sbu
LEFT JOIN prof e ON e.level = 'GLOBAL'"""


@query("J15_fallback_profile", with_("project", body="""
SELECT p.entity_id, coalesce(a.median, b.median, c.median, d.median, e.median) AS median, coalesce(a.n, b.n, c.n, d.n, e.n) AS n,
 coalesce(a.level, b.level, c.level, d.level, e.level) AS level_used """ + FALLBACK_FROM.format(n=60), extra=PROFILE_SQL))
def _(v):
    rows = v.project.select("entity_id", "sbu", "asset", "size_category", "contract_bucket")
    return fallback(rows, order_count_profile(v), "n_orders", ["median", "n"], min_n=60).select("entity_id", "median", "n", "level_used")


@query("J16_fallback_bounds", with_("project", body="""
SELECT p.entity_id, CAST(coalesce(a.p25, b.p25, d.p25, e.p25) AS DOUBLE) AS p25, CAST(coalesce(a.p75, b.p75, d.p75, e.p75) AS DOUBLE) AS p75,
 coalesce(a.level, b.level, d.level, e.level) AS level_used """ + FALLBACK_FROM.format(n=30), extra=PROFILE_SQL))
def _(v):
    constraints = order_count_profile(v).withColumn("bounds_json", bounds_json(["p25", "median", "p75"]))
    rows = v.project.select("entity_id", "sbu", "size_category", "contract_bucket")
    got = fallback_bounds(rows, constraints, "n_orders")
    return got.select("entity_id", F.col("bounds")["p25"].alias("p25"), F.col("bounds")["p75"].alias("p75"), F.col("bounds_level_used").alias("level_used"))


@query("J17_pair_or_general", with_("task", body="""
SELECT a.sow AS sow_first, a.nxt AS sow_second, coalesce(p.med, g.med) AS med, p.med IS NULL AS is_general
FROM (SELECT DISTINCT sow, nxt FROM pr) a
LEFT JOIN (SELECT sow, nxt, quantile_disc(d, 0.5) AS med FROM pr GROUP BY 1, 2 HAVING count(*) >= 190) p ON p.sow = a.sow AND p.nxt = a.nxt
JOIN (SELECT quantile_disc(d, 0.5) AS med FROM pr) g ON true""", extra="""
pr AS (SELECT sow, nxt, date_diff('day', s2, f) AS d FROM (SELECT *, lead(sow) OVER w AS nxt, lead(s) OVER w AS s2 FROM
 (SELECT entity_id, sow, min(task_start) s, max(task_end) f FROM task WHERE sow IS NOT NULL GROUP BY 1, 2) WINDOW w AS (PARTITION BY entity_id ORDER BY s, sow)) WHERE nxt IS NOT NULL)"""))
def _(v):
    t = v.task.filter(F.col("sow").isNotNull())
    s = t.groupBy("entity_id", "sow").agg(F.min("task_start").alias("s"), F.max("task_end").alias("f"))
    nxt = F.lead(F.struct("sow", "s")).over(W.partitionBy("entity_id").orderBy("s", "sow"))
    pairs = s.withColumn("nxt", nxt).filter("nxt IS NOT NULL").select(
        F.col("sow").alias("sow_first"), F.col("nxt.sow").alias("sow_second"), F.datediff("f", "nxt.s").alias("d")
    )
    med = Stats("d", {"med": 0.5})
    per = pairs.groupBy("sow_first", "sow_second").agg(F.count(F.lit(1)).alias("n"), *med.aggs()).filter("n >= 190")
    per = per.select("sow_first", "sow_second", *[c.alias(n) for n, c in med.columns().items()])
    general = pairs.agg(F.percentile_approx("d", 0.5, 100_000)).scalar()
    combos = pairs.select("sow_first", "sow_second").distinct()
    out = pair_or_general(combos, per.withColumn("hit", F.lit(True)), ["sow_first", "sow_second"], ["med", "hit"], {"med": general, "hit": F.lit(False)})
    return out.select("sow_first", "sow_second", "med", (~F.col("hit")).alias("is_general"))


CODES = {"error": ("ECONOMY", "PROMO"), "click": ("LARGE",), "view": ("SMALL", "MEDIUM", "STANDARD")}


@query("J18_category_to_codes", with_("event", body="""
SELECT e.event_id, m.code, k.n_parts FROM event e JOIN (VALUES ('error', 'ECONOMY'), ('error', 'PROMO'), ('click', 'LARGE'), ('view', 'SMALL'), ('view', 'MEDIUM'), ('view', 'STANDARD')) m(trade, code) ON m.trade = e.trade
JOIN (SELECT p_type, count(*) AS n_parts FROM part GROUP BY 1) k ON k.p_type = m.code"""))
def _(v):
    parts = v.table("part", "p_type").groupBy(F.col("p_type").alias("code")).agg(F.count(F.lit(1)).alias("n_parts"))
    return joins.map_to_codes(v.event, "trade", CODES).join(parts, "code").select("event_id", "code", "n_parts")


@query("J19_coverage_matrix", """
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_closed,
 c_custkey IN (SELECT user_id FROM events) AS has_events, false AS has_budget FROM customer""")
def _(v):
    closed = v.table("orders", "o_custkey", "o_orderstatus").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    events = v.table("events", "user_id").select(F.col("user_id").alias("c_custkey"))
    return joins.coverage(v.table("customer", "c_custkey"), "c_custkey", {"closed": closed, "events": events, "budget": None})


# sorts, limits, sets


@query("O1_total_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(v):
    return v.table("orders", "o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("O2_limit", "SELECT event_type AS trade, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, trade LIMIT 3")
def _(v):
    return v.event.groupBy("trade").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "trade").limit(3)


@query("O3_global_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def _(v):
    return v.table("orders", "o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5)


@query("O4_best_duplicate", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) rn FROM orders) WHERE rn = 1""")
def _(v):
    return best_duplicate(v.table("orders", "o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", ["o_orderkey"])


@query("O5_union_missing_columns", """
SELECT n_name AS name, n_regionkey AS region_key, CAST(NULL AS DOUBLE) AS balance FROM nation UNION ALL SELECT c_name, NULL, c_acctbal FROM customer""")
def _(v):
    a = v.table("nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region_key"))
    b = v.table("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return setops.union_all([a, b])


@query("O6_intersect_keys", "SELECT user_id AS k FROM events INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def _(v):
    a = v.table("events", "user_id").select(F.col("user_id").alias("k"))
    b = v.table("orders", "o_custkey", "o_orderstatus").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return setops.shared_keys(a, b, "k")


@query("O7_missing_values", """
SELECT c_mktsegment FROM (VALUES ('building'), ('household'), ('aviation'), ('federal')) t(c_mktsegment)
EXCEPT SELECT lower(trim(c_mktsegment)) FROM customer""")
def _(v):
    return setops.missing_values(v.table("customer", "c_mktsegment"), "c_mktsegment", ["building", "household", "aviation", "federal"])
