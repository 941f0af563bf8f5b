"""Lifecycle traces on the test tables seen as generated ones."""

from pyspark.sql import functions as F

from sigloom.bindings.aggregating import rounded
from sigloom.bindings.metrics import mi
from sigloom.bindings.registry import query
from sigloom.bindings.validating import V, tables
from sigloom.bindings.views import with_
from sigloom.plans import traces

NEEDED = ("project", "version")
NAMED = ("D SERVICES", "C INTERIORS")


def t1(t):
    s = t["schedule"]
    return traces.sequencing(s, "effective_from", "dt_tco", limit=0.50, digits=6)


T1 = """
t1 AS (SELECT n.entity_id, n.n_rows, coalesce(p.n_pairs, 0) AS n_pairs, coalesce(p.n_inv, 0) AS n_inversions FROM (SELECT entity_id, count(*) AS n_rows FROM vs GROUP BY 1 HAVING count(*) >= 3) n LEFT JOIN
 (SELECT a.entity_id, count(*) AS n_pairs, count(*) FILTER (WHERE a.dt_tco > b.dt_tco) AS n_inv FROM vs a JOIN vs b ON a.entity_id = b.entity_id AND a.effective_from < b.effective_from GROUP BY 1) p USING (entity_id)),
r1 AS (SELECT *, round(n_inversions / CAST(n_pairs AS DOUBLE), 6) AS inversion_rate, n_inversions / CAST(n_pairs AS DOUBLE) <= 0.5 AS passed FROM t1)"""


@query("T1_sequence_inversions", with_(*NEEDED, extra=V + "," + T1, body="SELECT entity_id, n_rows, n_pairs, n_inversions, inversion_rate, passed FROM r1"))
def _(v):
    return t1(tables(v))


def t2(t):
    return traces.envelope_alignment(t["event"], t["task"].filter("is_active"), "due", "sow_start", "sow_finish", floor=0.6, digits=6)


T2 = """
r2 AS (SELECT entity_id, count(*) AS n_events, count(*) FILTER (WHERE due BETWEEN s - 30 AND e + 30) AS n_inside, round(count(*) FILTER (WHERE due BETWEEN s - 30 AND e + 30) / CAST(count(*) AS DOUBLE), 6) AS alignment_rate,
 count(*) FILTER (WHERE due BETWEEN s - 30 AND e + 30) / CAST(count(*) AS DOUBLE) >= 0.6 AS passed FROM ve JOIN (SELECT entity_id, min(sow_start) AS s, max(sow_finish) AS e FROM vt WHERE is_active GROUP BY 1) USING (entity_id) GROUP BY 1)"""


@query("T2_envelope_alignment", with_(*NEEDED, extra=V + "," + T2, body="SELECT * FROM r2"))
def _(v):
    return t2(tables(v))


def t3(t):
    return traces.scurve_shape(t["budget"], "dt_budget", "amt_jtd", digits=6)


T3 = f"""
mj AS (SELECT entity_id, {mi('dt_budget')} AS month, sum(amt_jtd) AS c FROM vb GROUP BY 1, 2),
mr AS (SELECT entity_id, max(c) OVER (PARTITION BY entity_id ORDER BY month ROWS UNBOUNDED PRECEDING) AS m, row_number() OVER (PARTITION BY entity_id ORDER BY month) - 1 AS i, count(*) OVER (PARTITION BY entity_id) AS n FROM mj),
mq AS (SELECT entity_id, max(n) AS n_months, max(m) AS peak, max(CASE WHEN i = greatest(1, n // 4) THEN m END) AS q1, max(CASE WHEN i = least(n - 1, 3 * n // 4) THEN m END) AS q3 FROM mr GROUP BY 1),
r3 AS (SELECT entity_id, n_months, round(q1 / peak * 100, 6) AS q1_pct, round(q3 / peak * 100, 6) AS q3_pct, q1 / peak > 0.5 AS front_loaded, q3 / peak < 0.55 AS no_convergence, q1 / peak <= 0.5 AND q3 / peak >= 0.55 AS passed FROM mq WHERE n_months >= 4 AND peak > 0)"""


@query("T3_scurve_shape", with_(*NEEDED, extra=V + "," + T3, body="SELECT * FROM r3"))
def _(v):
    return t3(tables(v))


def t4(t):
    return traces.anchor_spike(t["event"], t["schedule"].filter(~F.col("code").endswith("-BL")), t["project"], "due", "effective_from", digits=6)


T4 = """
an AS (SELECT entity_id, effective_from AS at FROM vs WHERE code NOT LIKE '%-BL'),
nr AS (SELECT a.entity_id, count(e.event_id) AS near FROM an a LEFT JOIN ve e ON e.entity_id = a.entity_id AND e.due BETWEEN a.at - 30 AND a.at + 30 GROUP BY 1),
r4 AS (SELECT entity_id, n_anchors, n_events, near, round(near / (n_events * (n_anchors * 60 / CAST(d AS DOUBLE))), 6) AS spike_ratio, near / (n_events * (n_anchors * 60 / CAST(d AS DOUBLE))) >= 0.8 AS passed
 FROM nr JOIN (SELECT entity_id, count(*) AS n_anchors FROM an GROUP BY 1) USING (entity_id) JOIN (SELECT entity_id, count(*) AS n_events FROM ve GROUP BY 1) USING (entity_id)
 JOIN (SELECT entity_id, date_diff('day', dt_start, dt_end) AS d FROM vp WHERE dt_end > dt_start) USING (entity_id))"""


@query("T4_anchor_spike", with_(*NEEDED, extra=V + "," + T4, body="SELECT * FROM r4"))
def _(v):
    return t4(tables(v))


def t5(t):
    return traces.phase_progression(t["schedule"], "effective_from", "dt_tco", tie="code")


T5 = """
th AS (SELECT entity_id, dt_tco - DATE '1970-01-01' AS d, CASE WHEN i <= n // 3 THEN 'early' WHEN i > n - n // 3 THEN 'late' ELSE 'mid' END AS ph FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS i, count(*) OVER (PARTITION BY entity_id) AS n FROM vs)),
md AS (SELECT entity_id, count(*) AS n_rows, quantile_cont(d, 0.5) FILTER (WHERE ph = 'early') AS e, quantile_cont(d, 0.5) FILTER (WHERE ph = 'mid') AS m, quantile_cont(d, 0.5) FILTER (WHERE ph = 'late') AS l FROM th GROUP BY 1 HAVING count(*) >= 6),
r5 AS (SELECT entity_id, n_rows, CAST(e AS DOUBLE) AS early_median, CAST(m AS DOUBLE) AS mid_median, CAST(l AS DOUBLE) AS late_median, e <= m AS early_before_mid, m <= l AS mid_before_late, e <= m AND m <= l AS passed FROM md)"""


@query("T5_phase_progression", with_(*NEEDED, extra=V + "," + T5, body="SELECT * FROM r5"))
def _(v):
    return t5(tables(v))


def t6(t):
    return traces.budget_alignment(t["task"].filter("is_active"), t["budget"], "dt_budget", "amt_jtd", "amt_ecac", digits=6)


T6 = f"""
b6 AS (SELECT entity_id, max(j) AS j, max(x) AS x FROM (SELECT entity_id, {mi('dt_budget')} AS month, sum(amt_jtd) AS j, sum(amt_ecac) AS x FROM vb GROUP BY 1, 2) GROUP BY 1),
s6 AS (SELECT entity_id, sum(n_completed) / CAST(sum(n_total) AS DOUBLE) AS s FROM vt WHERE is_active GROUP BY 1),
r6 AS (SELECT entity_id, round(s * 100, 6) AS schedule_pct, round(j / x * 100, 6) AS budget_pct, round(abs(s - j / x) * 100, 6) AS gap_pct, abs(s - j / x) <= 0.3 AS passed FROM s6 JOIN b6 USING (entity_id))"""


@query("T6_budget_alignment", with_(*NEEDED, extra=V + "," + T6, body="SELECT * FROM r6"))
def _(v):
    return t6(tables(v))


def t7(t):
    return traces.trade_mix(t["event"], "trade", NAMED, digits=6)


T7 = """
c7 AS (SELECT entity_id, trade, count(*) AS n FROM ve GROUP BY 1, 2),
r7 AS (SELECT entity_id, CAST(sum(n) AS BIGINT) AS n_events, round(coalesce(sum(n) FILTER (WHERE trade = 'D SERVICES'), 0) / CAST(sum(n) AS DOUBLE) * 100, 6) AS first_pct, round(coalesce(sum(n) FILTER (WHERE trade = 'C INTERIORS'), 0) / CAST(sum(n) AS DOUBLE) * 100, 6) AS second_pct,
 round(coalesce(sum(n) FILTER (WHERE trade IN ('D SERVICES', 'C INTERIORS')), 0) / CAST(sum(n) AS DOUBLE) * 100, 6) AS combined_pct, arg_min(trade, (-n, trade)) AS top_trade, coalesce(sum(n) FILTER (WHERE trade IN ('D SERVICES', 'C INTERIORS')), 0) / CAST(sum(n) AS DOUBLE) >= 0.4 AS passed FROM c7 GROUP BY 1)"""


@query("T7_trade_mix", with_(*NEEDED, extra=V + "," + T7, body="SELECT * FROM r7"))
def _(v):
    return t7(tables(v))


def line(t):
    return traces.timeline(t["project"], t["event"], t["task"].filter("is_active"), t["budget"])


T8 = f"""
s8 AS (SELECT entity_id, unnest(generate_series({mi('dt_start')}, {mi('dt_end')})) AS month FROM vp WHERE dt_end >= dt_start),
r8 AS (SELECT s.entity_id, s.month, CAST(s.month // 12 AS VARCHAR) || '-' || lpad(CAST(s.month % 12 + 1 AS VARCHAR), 2, '0') AS month_str, e.n AS n_events, coalesce(a.n, 0) AS n_active_sows, b.spend FROM s8 s
 LEFT JOIN (SELECT entity_id, {mi('created')} AS month, count(*) AS n FROM ve GROUP BY 1, 2) e USING (entity_id, month)
 LEFT JOIN (SELECT t.entity_id, s.month, count(*) AS n FROM (SELECT entity_id, {mi('sow_start')} AS a, {mi('sow_finish')} AS b FROM vt WHERE is_active) t JOIN s8 s ON s.entity_id = t.entity_id AND s.month BETWEEN t.a AND t.b GROUP BY 1, 2) a USING (entity_id, month)
 LEFT JOIN (SELECT entity_id, {mi('dt_budget')} AS month, sum(amt_jtd) AS spend FROM vb GROUP BY 1, 2) b USING (entity_id, month))"""


@query("T8_monthly_timeline", with_(*NEEDED, extra=V + "," + T8, body="SELECT entity_id, month, month_str, n_events, n_active_sows, round(spend, 2) AS spend FROM r8"))
def _(v):
    return rounded(line(tables(v)), 2)


T9 = T8 + """,
r9 AS (SELECT entity_id, max(t) AS total_months, count(*) AS core_months, count(*) FILTER (WHERE n_active_sows = 0) AS dead_months, round(count(*) FILTER (WHERE n_active_sows = 0) / CAST(count(*) AS DOUBLE), 6) AS dead_rate,
 count(*) FILTER (WHERE n_active_sows = 0) / CAST(count(*) AS DOUBLE) <= 0.1 AS passed FROM (SELECT *, min(month) OVER p AS lo, max(month) OVER p AS hi, count(*) OVER p AS t FROM r8 WINDOW p AS (PARTITION BY entity_id)) WHERE t > 2 AND month > lo AND month < hi GROUP BY 1)"""


def t9(t):
    return traces.event_density(line(t), digits=6)


@query("T9_dead_months", with_(*NEEDED, extra=V + "," + T9, body="SELECT * FROM r9"))
def _(v):
    return t9(tables(v))


PARTS = {"sequencing": ("r1", t1), "alignment": ("r2", t2), "scurve": ("r3", t3), "spike": ("r4", t4), "phases": ("r5", t5), "budget": ("r6", t6), "trade mix": ("r7", t7), "density": ("r9", t9)}
SUMMARY = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE passed) AS n_passed, count(*) AS n_checked, round(count(*) FILTER (WHERE passed) * CAST(100 AS DOUBLE) / count(*), 1) AS pct FROM {r}" for n, (r, _f) in PARTS.items())


@query("T10_trace_summary", with_(*NEEDED, extra=",".join([V, T1, T2, T3, T4, T5, T6, T7, T9]), body=SUMMARY))
def _(v):
    t = tables(v, stored=True)  # read by several checks each
    return traces.summary({n: f(t) for n, (_r, f) in PARTS.items()})
