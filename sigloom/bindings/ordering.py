"""Window operators on the test tables. Chains of one entity are sliced when they are long."""

from pyspark.sql import functions as F

from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.operators import windows as win
from sigloom.operators.joins import share_of_all, share_of_group

BY_CODE = "PARTITION BY entity_id ORDER BY effective_from, code"
CHAIN = ["effective_from", "code"]


@query("W1_version_number", with_("version", body=f"SELECT entity_id, code, CAST(row_number() OVER ({BY_CODE}) AS INTEGER) AS seq FROM version"))
def _(v):
    return win.sequence_number(v.version.select("entity_id", *CHAIN), ["entity_id"], CHAIN).select("entity_id", "code", "seq")


@query("W2_sequence_with_tiebreak", with_("task", body="""
SELECT entity_id, sow, s, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY s, sow) AS INTEGER) AS seq FROM (SELECT entity_id, sow, min(task_start) AS s FROM task WHERE sow IS NOT NULL GROUP BY 1, 2)"""))
def _(v):
    s = v.task.filter("sow IS NOT NULL").groupBy("entity_id", "sow").agg(F.min("task_start").alias("s"))
    return win.sequence_number(s, ["entity_id"], ["s", "sow"])


@query("W3_version_delays", with_("version", body=f"""
SELECT entity_id, code, delay_days FROM (SELECT entity_id, code, date_diff('day', lag(target_date) OVER ({BY_CODE}), target_date) AS delay_days FROM version) WHERE delay_days > 0"""))
def _(v):
    df = v.version.select("entity_id", *CHAIN, "target_date")
    return win.delays(df, ["entity_id"], CHAIN, "target_date").select("entity_id", "code", "delay_days")


@query("W4_true_changes", with_("version", body=f"""
SELECT entity_id, code, p AS prev_is_active FROM (SELECT *, lag(is_active) OVER ({BY_CODE}) AS p FROM version) WHERE p IS NOT NULL AND p <> is_active"""))
def _(v):
    df = v.version.select("entity_id", *CHAIN, "is_active")
    return win.changes(df, ["entity_id"], CHAIN, "is_active").select("entity_id", "code", "prev_is_active")


@query("W5_regressions", with_("entity", body="""
SELECT cust_id, entity_id, amt_contract FROM (SELECT *, lag(amt_contract) OVER (PARTITION BY cust_id ORDER BY dt_start, entity_id) AS p FROM entity) WHERE amt_contract < p - 1000"""))
def _(v):
    df = v.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").select(
        F.col("o_custkey").alias("cust_id"), F.col("o_orderkey").alias("entity_id"), F.col("o_totalprice").alias("amt_contract"), F.to_date("o_orderdate").alias("dt_start")
    )
    return win.regressions(df, ["cust_id"], ["dt_start", "entity_id"], "amt_contract", 1000.0).select("cust_id", "entity_id", "amt_contract")


@query("W6_interval_overlaps", with_("version", body=f"""
SELECT entity_id, code, next_start FROM (SELECT *, lead(effective_from) OVER ({BY_CODE}) AS next_start FROM version) WHERE effective_from + 90 > next_start"""))
def _(v):
    df = v.version.select("entity_id", *CHAIN, F.date_add("effective_from", 90).alias("until"))
    return win.overlaps(df, ["entity_id"], "effective_from", "until", tie=["code"]).select("entity_id", "code", "next_start")


@query("W7_ratio_to_next", with_("version", body="""
SELECT entity_id, mon, round(nxt / CAST(n AS DOUBLE), 3) AS ratio FROM (SELECT *, lead(n) OVER (PARTITION BY entity_id ORDER BY mon) AS nxt FROM
 (SELECT entity_id, CAST(date_trunc('year', effective_from) AS DATE) AS mon, count(*) AS n FROM version GROUP BY 1, 2)) WHERE n >= 2 AND nxt IS NOT NULL AND round(nxt / CAST(n AS DOUBLE), 3) BETWEEN 0.5 AND 2"""))
def _(v):
    n = v.version.groupBy("entity_id", F.trunc("effective_from", "year").alias("mon")).agg(F.count(F.lit(1)).alias("n"))
    return win.ratio_to_next(n, ["entity_id"], ["mon"], "n", 0.5, 2.0, 2).select("entity_id", "mon", "ratio")


@query("W8_share_in_partition", "SELECT p_brand, p_type, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY p_brand), 4) AS pct FROM part GROUP BY 1, 2")
def _(v):
    n = v.table("part", "p_brand", "p_type").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return share_of_group(n, ["p_brand"], "n", "pct")


@query("W9_share_of_grand_total", with_("version", body="""
SELECT n_versions, count(*) AS n, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 4) AS pct FROM (SELECT entity_id, count(*) AS n_versions FROM version GROUP BY 1) GROUP BY 1"""))
def _(v):
    per = v.version.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_versions"))
    return share_of_all(per.groupBy("n_versions").agg(F.count(F.lit(1)).alias("n")), "n", "pct")


@query("W10_monotone_repair", with_("entity", body="""
SELECT cust_id, entity_id, round(max(least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), amt_contract / 450000))) OVER (PARTITION BY cust_id ORDER BY dt_start, entity_id ROWS UNBOUNDED PRECEDING), 8) AS monotone FROM entity"""))
def _(v):
    df = v.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").select(
        F.col("o_custkey").alias("cust_id"), F.col("o_orderkey").alias("entity_id"), (F.col("o_totalprice") / 450_000).alias("x"), F.to_date("o_orderdate").alias("d")
    )
    return win.monotone(df, ["cust_id"], ["d", "entity_id"], "x").select("cust_id", "entity_id", F.round("monotone", 8).alias("monotone"))


@query("W11_top_k", "SELECT lang, doc_id, n_chars, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 10")
def _(v):
    return win.top_k(v.table("documents", "lang", "doc_id", "n_chars"), ["lang"], [F.desc("n_chars"), "doc_id"], 10)


@query("W12_closing_dates", with_("version", body="""
SELECT entity_id, code, effective_from, CASE WHEN nxt IS NULL THEN DATE '2099-12-31' ELSE greatest(effective_from, nxt - 1) END AS effective_to
FROM (SELECT *, lead(effective_from) OVER (PARTITION BY entity_id ORDER BY effective_from, code) AS nxt FROM version)"""))
def _(v):
    return win.closing_dates(v.version.select("entity_id", *CHAIN), ["entity_id"], "effective_from", tie=["code"]).select("entity_id", "code", "effective_from", "effective_to")


@query("W13_countdown", with_("version", body="""
SELECT entity_id, code, CAST(row_number() OVER w AS INTEGER) AS n_recent, row_number() OVER w = 1 AS is_active FROM version WINDOW w AS (PARTITION BY entity_id ORDER BY effective_from DESC, code DESC)"""))
def _(v):
    return win.countdown(v.version.select("entity_id", *CHAIN), ["entity_id"], CHAIN).select("entity_id", "code", "n_recent", "is_active")


@query("W14_minimum_gap", with_("version", body="""
SELECT entity_id, code, round(least(CAST(0.95 AS DOUBLE), greatest(i * CAST(0.05 AS DOUBLE), i * CAST(0.05 AS DOUBLE) + max(t - i * CAST(0.05 AS DOUBLE)) OVER (PARTITION BY entity_id ORDER BY i ROWS UNBOUNDED PRECEDING))), 8) AS spaced
FROM (SELECT entity_id, code, t, row_number() OVER (PARTITION BY entity_id ORDER BY t, code) AS i FROM (SELECT *, (code * 7919 % 1000) / CAST(1000 AS DOUBLE) AS t FROM version))"""))
def _(v):
    t = (F.col("code") * 7919 % 1000) / 1000.0
    df = v.version.select("entity_id", "code", t.alias("t"))
    return win.spaced(df, ["entity_id"], ["t", "code"], "t", 0.05, 0.95).select("entity_id", "code", F.round("spaced", 8).alias("spaced"))


@query("W15_cumulative_shift", with_("version", body=f"""
SELECT entity_id, code, DATE '2000-01-01' + CAST(sum(code % 30) OVER ({BY_CODE} ROWS UNBOUNDED PRECEDING) AS INTEGER) AS shifted FROM version"""))
def _(v):
    df = v.version.select("entity_id", *CHAIN, (F.col("code") % 30).alias("days"), F.lit("2000-01-01").cast("date").alias("base"))
    return win.shifted(df, ["entity_id"], CHAIN, "base", "days").select("entity_id", "code", "shifted")


MONTHLY = """
m AS (SELECT entity_id, (year(task_start) - 1995) * 12 + month(task_start) AS mon, count(*) AS n, bool_or(start_source = 'early start' AND target > 40) AS flag FROM task GROUP BY 1, 2)"""


def monthly(v):
    """One row per entity and month: bounded by the months of the data."""
    mon = ((F.year("task_start") - 1995) * 12 + F.month("task_start")).alias("mon")
    flag = F.bool_or((F.col("start_source") == "early start") & (F.col("target") > 40)).alias("flag")
    return v.task.groupBy("entity_id", mon).agg(F.count(F.lit(1)).alias("n"), flag)


@query("W16_rolling_mean", with_("task", body="SELECT entity_id, mon, round(avg(n) OVER (PARTITION BY entity_id ORDER BY mon ROWS 2 PRECEDING), 6) AS rate3 FROM m", extra=MONTHLY))
def _(v):
    return win.rolling_mean(monthly(v), ["entity_id"], "mon", "n").select("entity_id", "mon", F.round("rate3", 6).alias("rate3"))


@query("W17_periods_since", with_("task", body="""
SELECT entity_id, mon, mon - max(CASE WHEN flag THEN mon END) OVER (PARTITION BY entity_id ORDER BY mon ROWS UNBOUNDED PRECEDING) AS since FROM m""", extra=MONTHLY))
def _(v):
    return win.periods_since(monthly(v), ["entity_id"], "mon", "flag").select("entity_id", "mon", "since")


@query("W18_forward_frame", with_("task", body="""
SELECT entity_id, mon, count(*) OVER f AS n_rows, coalesce(sum(n) OVER f, 0) AS n_ahead, coalesce(bool_or(flag) OVER f, false) AS any_flag
FROM m WINDOW f AS (PARTITION BY entity_id ORDER BY mon RANGE BETWEEN 1 FOLLOWING AND 6 FOLLOWING)""", extra=MONTHLY))
def _(v):
    from pyspark.sql import Window as W

    f = W.partitionBy("entity_id").orderBy("mon").rangeBetween(1, 6)
    return monthly(v).select(
        "entity_id", "mon", F.count(F.lit(1)).over(f).alias("n_rows"), F.coalesce(F.sum("n").over(f), F.lit(0)).alias("n_ahead"),
        F.coalesce(F.bool_or("flag").over(f), F.lit(False)).alias("any_flag"),
    )


@query("W19_thirds", with_("version", body=f"""
SELECT entity_id, code, CASE WHEN i <= n // 3 THEN 'early' WHEN i > n - n // 3 THEN 'late' ELSE 'mid' END AS phase
FROM (SELECT *, row_number() OVER ({BY_CODE}) AS i, count(*) OVER (PARTITION BY entity_id) AS n FROM version)"""))
def _(v):
    return win.thirds(v.version.select("entity_id", *CHAIN), ["entity_id"], CHAIN).select("entity_id", "code", "phase")


@query("W20_inversions", with_("version", body="""
SELECT n.entity_id, n.n_rows, coalesce(p.n_pairs, 0) AS n_pairs, coalesce(p.n_inversions, 0) AS n_inversions FROM (SELECT entity_id, count(*) AS n_rows FROM version GROUP BY 1) n LEFT JOIN
 (SELECT a.entity_id, count(*) AS n_pairs, count(*) FILTER (WHERE a.target_date > b.target_date) AS n_inversions FROM version a JOIN version b ON a.entity_id = b.entity_id AND a.effective_from < b.effective_from GROUP BY 1) p USING (entity_id)"""))
def _(v):
    return win.inversions(v.version.select("entity_id", "effective_from", "target_date"), "entity_id", "effective_from", "target_date")
