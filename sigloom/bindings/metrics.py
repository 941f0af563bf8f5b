"""Earned-value metrics on monthly snapshots of each customer."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.bindings.aggregating import rounded
from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.operators.windows import rolling_mean
from sigloom.plans import evm


def mi(x):
    return f"(year({x}) * 12 + month({x}) - 1)"


SNAP = f"""
spine AS (SELECT entity_id, unnest(generate_series({mi('dt_start')}, {mi('dt_end')})) AS month FROM project WHERE dt_end >= dt_start),
sp AS (SELECT entity_id, {mi('dt_budget')} AS month, sum(amt_original) AS spend, count(*) AS n FROM ledger GROUP BY 1, 2),
tot AS (SELECT entity_id, count(*) AS total FROM ledger GROUP BY 1),
vs AS (SELECT entity_id, {mi('effective_from')} AS month, count(*) AS n_v, max(target_date) AS t FROM version GROUP BY 1, 2),
mk AS (SELECT entity_id, {mi('effective_from')} AS month, 1 AS d FROM version UNION ALL SELECT entity_id, {mi('target_date')}, -1 FROM version),
bl AS (SELECT s.entity_id, s.month, (SELECT coalesce(sum(d), 0) FROM mk WHERE mk.entity_id = s.entity_id AND mk.month <= s.month) AS open_items FROM spine s),
base AS (SELECT s.entity_id, s.month, s.month - {mi('p.dt_start')} + 1 AS sim_month, {mi('p.dt_end')} - {mi('p.dt_start')} + 1 AS n_months, p.dt_start, p.amt_cost AS budget, p.amt_contract,
  coalesce(sum(sp.spend) OVER u, 0) AS cum_spend, coalesce(sum(sp.n) OVER u, 0) / CAST(tot.total AS DOUBLE) AS pct_complete, max(vs.t) OVER u AS current_tco, p.dt_start + 730 AS original_tco,
  coalesce(vs.n_v, 0) AS n_v, avg(coalesce(vs.n_v, 0)) OVER (PARTITION BY s.entity_id ORDER BY s.month ROWS 2 PRECEDING) AS rate3
 FROM spine s JOIN project p USING (entity_id) JOIN tot USING (entity_id) LEFT JOIN sp ON sp.entity_id = s.entity_id AND sp.month = s.month LEFT JOIN vs ON vs.entity_id = s.entity_id AND vs.month = s.month
 WINDOW u AS (PARTITION BY s.entity_id ORDER BY s.month ROWS UNBOUNDED PRECEDING)),
ev AS (SELECT *, sim_month / CAST(n_months AS DOUBLE) AS planned_pct, n_v > 0 AND sim_month > 1 AS is_reb, sim_month / CAST(n_months AS DOUBLE) * budget AS planned_value, pct_complete * budget AS earned_value FROM base),
ix AS (SELECT *, CASE WHEN planned_pct > 0 THEN least(CAST(2 AS DOUBLE), pct_complete / planned_pct) ELSE CAST(1 AS DOUBLE) END AS spi, CASE WHEN cum_spend > 0 THEN least(CAST(2 AS DOUBLE), earned_value / cum_spend) ELSE CAST(1 AS DOUBLE) END AS bpi FROM ev),
ea AS (SELECT *, CASE WHEN bpi > 0 THEN greatest(budget, cum_spend + greatest(CAST(0 AS DOUBLE), budget - cum_spend) * greatest(CAST(0.7 AS DOUBLE), CAST(0.95 AS DOUBLE) - CAST(0.25 AS DOUBLE) * planned_pct) / bpi) ELSE CAST(1.5 AS DOUBLE) * budget END AS eac FROM ix)"""
VIEWS = ("project", "ledger", "version")


def spine(v):
    return evm.month_spine(v.project, "entity_id", "dt_start", "dt_end")


def snapshot(v):
    """Monthly state per customer: spend, progress, versions."""
    led = v.ledger.groupBy("entity_id", evm.month_index("dt_budget").alias("month")).agg(F.sum("amt_original").alias("spend"), F.count(F.lit(1)).alias("n"))
    led = led.groupBy("entity_id").agg(F.sum("n").alias("total"), evm.month_map("month", ("spend", "n")).alias("__led"))
    vs = v.version.groupBy("entity_id", evm.month_index("effective_from").alias("month")).agg(F.count(F.lit(1)).alias("n_v"), F.max("target_date").alias("t"))
    vs = vs.groupBy("entity_id").agg(evm.month_map("month", ("n_v", "t")).alias("__vs"))
    p = v.project.select("entity_id", "dt_start", "dt_end", F.col("amt_cost").alias("budget"), "amt_contract")
    # months are looked up in their entity's row, so the many months are not dealt anew for each table
    df = spine(v).join(p, "entity_id").join(led, "entity_id").join(vs, "entity_id", "left")
    of = {"spend": "__led", "n": "__led", "n_v": "__vs", "t": "__vs"}
    df = df.withColumns({c: F.try_element_at(m, F.col("month"))[c] for c, m in of.items()}).drop("__led", "__vs")
    u = W.partitionBy("entity_id").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    first = evm.month_index("dt_start")
    df = df.withColumns(
        {
            "sim_month": F.col("month") - first + 1,
            "n_months": evm.month_index("dt_end") - first + 1,
            "cum_spend": F.coalesce(F.sum("spend").over(u), F.lit(0.0)),
            "pct_complete": F.coalesce(F.sum("n").over(u), F.lit(0)) / F.col("total"),
            "current_tco": F.max("t").over(u),
            "original_tco": F.date_add("dt_start", 730),
            "n_v": F.coalesce("n_v", F.lit(0)),
        }
    )
    df = rolling_mean(df, ["entity_id"], "month", "n_v")
    df = df.withColumns({"planned_pct": F.col("sim_month") / F.col("n_months"), "is_reb": (F.col("n_v") > 0) & (F.col("sim_month") > 1)})
    return evm.values(df, "pct_complete", "planned_pct", "budget")


def indexed(v):
    return evm.indices(snapshot(v), "pct_complete", "planned_pct", "cum_spend")


def with_eac(v):
    return evm.eac(indexed(v), "cum_spend", "budget", "bpi", "planned_pct")


def backlog(v):
    return evm.open_backlog(spine(v), v.version, "entity_id", "effective_from", "target_date")


@query("E1_planned_earned_value", with_(*VIEWS, extra=SNAP, body="SELECT entity_id, month, round(planned_value, 6) AS planned_value, round(earned_value, 6) AS earned_value FROM ev"))
def _(v):
    return rounded(snapshot(v).select("entity_id", "month", "planned_value", "earned_value"), 6)


@query("E2_spi_bpi", with_(*VIEWS, extra=SNAP, body="SELECT entity_id, month, round(spi, 8) AS spi, round(bpi, 8) AS bpi FROM ix"))
def _(v):
    return rounded(indexed(v).select("entity_id", "month", "spi", "bpi"), 8)


@query("E3_eac", with_(*VIEWS, extra=SNAP, body="SELECT entity_id, month, round(eac, 3) AS eac FROM ea"))
def _(v):
    return rounded(with_eac(v).select("entity_id", "month", "eac"), 3)


BEHIND = SNAP + """,
seg AS (SELECT *, sum(CASE WHEN spi < 1 THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY month ROWS UNBOUNDED PRECEDING) AS run FROM ix),
db AS (SELECT *, greatest(0, coalesce(max(CASE WHEN spi < 1 THEN CAST(greatest(0, floor(sim_month * 30 / greatest(CAST(0.5 AS DOUBLE), spi) - sim_month * 30)) AS INTEGER) END) OVER w, 0)
  - coalesce(sum(CASE WHEN spi < 1 THEN 0 ELSE CAST(floor(5 * (spi - 1) * 30) AS INTEGER) END) OVER w, 0)) AS days_behind FROM seg WINDOW w AS (PARTITION BY entity_id, run ORDER BY month ROWS UNBOUNDED PRECEDING))"""


@query("E4_days_behind_float", with_(*VIEWS, extra=BEHIND, body="""
SELECT entity_id, month, CAST(days_behind AS INTEGER) AS days_behind, round(least(CAST(1 AS DOUBLE), days_behind / CAST(greatest(1, date_diff('day', make_date(month // 12, month % 12 + 1, 1), original_tco)) AS DOUBLE)), 6) AS pct_float_consumed FROM db"""))
def _(v):
    df = evm.days_behind(indexed(v), "entity_id", "month", "sim_month", "spi")
    snap = F.make_date(F.floor(F.col("month") / 12).cast("int"), F.col("month") % 12 + 1, F.lit(1))
    df = evm.float_consumed(df.withColumn("snap", snap), "snap", "original_tco")
    return rounded(df.select("entity_id", "month", "days_behind", "pct_float_consumed"))


RISK_SQL = """least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), CAST(0.4 AS DOUBLE) * greatest(CAST(0 AS DOUBLE), 1 - spi) + CAST(0.4 AS DOUBLE) * greatest(CAST(0 AS DOUBLE), 1 - bpi)
 + CAST(0.2 AS DOUBLE) * least(CAST(1 AS DOUBLE), open_items / greatest(CAST(1 AS DOUBLE), rate3 * 3))))"""


@query("E5_composite_risk", with_(*VIEWS, extra=SNAP, body=f"SELECT entity_id, month, round({RISK_SQL}, 12) AS composite_risk FROM ix JOIN bl USING (entity_id, month)"))
def _(v):
    df = indexed(v).join(backlog(v), ["entity_id", "month"])
    return df.select("entity_id", "month", F.round(evm.composite_risk("spi", "bpi", "open_items", "rate3"), 12).alias("composite_risk"))


@query("E6_spi_transitions", with_(*VIEWS, extra=SNAP, body="""
SELECT from_state, to_state, count(*) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY from_state) AS DOUBLE), 6) AS prob FROM (SELECT to_state, lag(to_state) OVER (PARTITION BY entity_id ORDER BY month) AS from_state FROM
 (SELECT entity_id, month, CASE WHEN spi < 0.85 THEN 0 WHEN spi < 0.92 THEN 1 WHEN spi < 1 THEN 2 WHEN spi < 1.08 THEN 3 ELSE 4 END AS to_state FROM ix)) WHERE from_state IS NOT NULL GROUP BY 1, 2"""))
def _(v):
    return evm.state_transitions(indexed(v), "entity_id", "month", "spi")


@query("E7_open_backlog", with_(*VIEWS, extra=SNAP, body="SELECT entity_id, month, open_items FROM bl"))
def _(v):
    return backlog(v)


@query("E8_monthly_burn", with_(*VIEWS, extra=SNAP, body="SELECT entity_id, month, round(greatest(CAST(0 AS DOUBLE), cum_spend - coalesce(lag(cum_spend) OVER (PARTITION BY entity_id ORDER BY month), 0)), 2) AS monthly_burn FROM base"))
def _(v):
    return rounded(evm.monthly_burn(snapshot(v), "entity_id", "month", "cum_spend").select("entity_id", "month", "monthly_burn"), 2)


@query("E9_guardrails", with_(*VIEWS, extra=SNAP, body="""
SELECT entity_id, month, round(max(least(CAST(1 AS DOUBLE), pct_complete)) OVER (PARTITION BY entity_id ORDER BY month ROWS UNBOUNDED PRECEDING), 8) AS pct_complete, round(least(eac, 1.08 * amt_contract), 3) AS eac,
 round(least(greatest(CAST(0 AS DOUBLE), cum_spend - coalesce(lag(cum_spend) OVER (PARTITION BY entity_id ORDER BY month), 0)), 0.08 * amt_contract), 3) AS monthly_burn,
 round(greatest(0.5, least(1.5, spi)), 8) AS spi, round(greatest(0.5, least(1.5, bpi)), 8) AS bpi, greatest(current_tco, original_tco) AS current_tco FROM ea"""))
def _(v):
    df = evm.guardrails(evm.monthly_burn(with_eac(v), "entity_id", "month", "cum_spend"), "entity_id", "month")
    r = {"pct_complete": 8, "eac": 3, "monthly_burn": 3, "spi": 8, "bpi": 8}
    return df.select("entity_id", "month", *[F.round(c, d).alias(c) for c, d in r.items()], "current_tco")


AUDIT = SNAP + """,
au AS (SELECT x.entity_id, x.month, x.is_reb, x.spi, bl.open_items, x.current_tco FROM ix x JOIN bl USING (entity_id, month)),
post AS (SELECT a.entity_id, a.month, a.open_items AS now, count(b.month) AS n_after, coalesce(bool_or(b.spi > 0.92) FILTER (WHERE b.month <= a.month + 3), false) AS recovered,
 count(DISTINCT b.current_tco) FILTER (WHERE b.month <= a.month + 4) <= 1 AS stable, min(b.open_items) FILTER (WHERE b.month <= a.month + 2) AS low
 FROM au a LEFT JOIN au b ON a.entity_id = b.entity_id AND b.month > a.month AND b.month <= a.month + 6 WHERE a.is_reb GROUP BY 1, 2, 3),
vd AS (SELECT *, coalesce(now > 0 AND (now - low) / CAST(now AS DOUBLE) >= 0.2, false) AS resolved FROM post)"""


@query("E10_rebaseline_audit", with_(*VIEWS, extra=AUDIT, body="""
SELECT entity_id, month, n_after, recovered, stable, resolved, CASE WHEN n_after < 3 THEN 'inconclusive' WHEN recovered AND NOT stable AND NOT resolved THEN 'premature' WHEN stable AND (resolved OR NOT recovered) THEN 'justified'
 WHEN resolved THEN 'justified' ELSE 'inconclusive' END AS verdict FROM vd"""))
def _(v):
    df = indexed(v).join(backlog(v), ["entity_id", "month"])
    return evm.rebaseline_audit(df, "entity_id", "month", "is_reb", "spi", "current_tco", "open_items")


@query("E11_cost_flags", with_(*VIEWS, extra=SNAP, body="""
SELECT entity_id, month, round(eac / greatest(1, amt_contract), 6) AS eac_contract_ratio, eac / greatest(1, amt_contract) > 1.00 AS is_at_risk, eac / greatest(1, amt_contract) > 1.02 AS is_distressed FROM ea"""))
def _(v):
    return rounded(with_eac(v).select("entity_id", "month", *[c.alias(n) for n, c in evm.cost_flags("eac", "amt_contract").items()]))


@query("E12_change_order_rollup", with_("ledger", body=f"""
SELECT entity_id, month, CAST(sum(na) OVER u AS BIGINT) AS n_approved, round(sum(aa) OVER u, 4) AS amt_approved, CAST(sum(np) OVER u AS BIGINT) AS n_pending, round(sum(ap) OVER u, 4) AS amt_pending FROM (
 SELECT entity_id, {mi('dt_budget')} AS month, count(*) FILTER (WHERE pending_in > 0) AS na, sum(CASE WHEN pending_in > 0 THEN amt_direct ELSE 0 END) AS aa, count(*) FILTER (WHERE pending_in <= 0 AND pending_out < 0) AS np,
  sum(CASE WHEN pending_in <= 0 AND pending_out < 0 THEN amt_direct ELSE 0 END) AS ap FROM ledger GROUP BY 1, 2) WINDOW u AS (PARTITION BY entity_id ORDER BY month ROWS UNBOUNDED PRECEDING)"""))
def _(v):
    status = F.when(F.col("pending_in") > 0, "approved").when(F.col("pending_out") < 0, "pending").otherwise("none")
    cos = v.ledger.select("entity_id", evm.month_index("dt_budget").alias("month"), status.alias("status"), "amt_direct")
    return rounded(evm.change_order_rollup(cos, "entity_id", "month", "status", "amt_direct"), 4)


@query("E13_entity_registry", with_(*VIEWS, extra=SNAP, body="""
SELECT entity_id, count(*) AS n_months, round(arg_max(spi, month), 8) AS final_spi, round(arg_max(bpi, month), 8) AS final_bpi, round(arg_max(eac, month), 3) AS final_eac, CAST(sum(n_v) AS BIGINT) AS n_versions FROM ea GROUP BY 1"""))
def _(v):
    df = evm.registry(with_eac(v), "entity_id", "month", ["spi", "bpi", "eac"], {"n_versions": F.sum("n_v")})
    return df.select("entity_id", "n_months", F.round("final_spi", 8).alias("final_spi"), F.round("final_bpi", 8).alias("final_bpi"), F.round("final_eac", 3).alias("final_eac"), "n_versions")
