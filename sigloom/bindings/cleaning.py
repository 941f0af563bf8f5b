"""Cleaning and bucketing operators on the test tables."""

from pyspark.sql import functions as F

from sigloom.bindings.registry import query
from sigloom.bindings.views import SIZE, bucket_sql, with_
from sigloom.functions import buckets, clean, values
from sigloom.operators.quantiles import Stats, group_stats


@query("P1_date_normalisation", with_(body="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"""))
def _(v):
    return clean.dates(v.table("orders", "o_orderkey", "o_orderdate"), ["o_orderdate"])


@query("P2_repair_reversed_range", with_("entity", body="""
SELECT entity_id, dt_start, CASE WHEN dt_end < dt_start THEN dt_start ELSE dt_end END AS dt_end FROM entity"""))
def _(v):
    return v.entity.select("entity_id", "dt_start", clean.repair_end("dt_start", "dt_end").alias("dt_end"))


@query("P3_cast_floor_default", with_("entity", body="""
SELECT entity_id, CASE WHEN coalesce(CAST(n_floors AS INTEGER), 1) < 2 THEN 2 ELSE coalesce(CAST(n_floors AS INTEGER), 1) END AS n_floors,
  CASE WHEN gross_area < 25 THEN CAST(25 AS DOUBLE) ELSE gross_area END AS gross_area FROM entity"""))
def _(v):
    return v.entity.select(
        "entity_id",
        clean.cast_floor("n_floors", "int", 2, default=1).alias("n_floors"),
        clean.cast_floor("gross_area", "double", 25).alias("gross_area"),
    )


@query("P4_guarded_ratio", with_("entity", body="""
SELECT entity_id, round(CASE WHEN amt_contract > 0 THEN amt_cost / amt_contract END, 6) AS cost_ratio,
  round(CASE WHEN gross_area - 100.7 > 0 THEN amt_cost / (gross_area - 100.7) END, 4) AS cost_per_extra FROM entity"""))
def _(v):
    return v.entity.select(
        "entity_id",
        F.round(clean.ratio("amt_cost", "amt_contract"), 6).alias("cost_ratio"),
        F.round(clean.ratio("amt_cost", F.col("gross_area") - 100.7), 4).alias("cost_per_extra"),
    )


@query("P5_universe_filter", with_("entity", body="""
SELECT entity_id, sbu, amt_contract, dt_start FROM entity
WHERE status = 'O' AND amt_contract >= 50000 AND dt_start >= DATE '1997-01-01' AND region IS NOT NULL
  AND date_diff('day', dt_start, dt_end) > 30"""))
def _(v):
    df = v.entity.withColumn("is_latest", F.col("status") == "O")
    return clean.universe(
        df, latest="is_latest", amount="amt_contract", min_amount=50_000.0, start="dt_start", start_year=1997,
        required=["region"], end="dt_end", longer_than=30,
    ).select("entity_id", "sbu", "amt_contract", "dt_start")


@query("P6_missing_flags", with_("entity", body="""
SELECT entity_id, n_floors IS NULL AS is_n_floors_missing, gross_area IS NULL AS is_gross_area_missing,
  dt_end IS NULL AS is_dt_end_missing, asset IS NULL AS is_asset_missing FROM entity"""))
def _(v):
    df = clean.missing_flags(v.entity, ["n_floors", "gross_area", "dt_end", "asset"])
    return df.select("entity_id", *[c for c in df.columns if c.endswith("_missing")])


@query("P7_bucket_left_closed", with_("entity", body=f"""
SELECT entity_id, {bucket_sql('gross_area', (50.0, 100.0, 200.0), SIZE)} AS size_category,
  coalesce({bucket_sql('gross_area', (50.0, 100.0, 200.0), SIZE)}, 'XLarge') AS size_null_to_last FROM entity"""))
def _(v):
    edges = (50.0, 100.0, 200.0)
    return v.entity.select(
        "entity_id",
        buckets.size("gross_area", edges).alias("size_category"),
        buckets.size("gross_area", edges, null_to_last=True).alias("size_null_to_last"),
    )


@query("P8_bucket_right_closed", with_("entity", body="""
SELECT entity_id, CASE WHEN gross_area IS NULL OR gross_area <= 10 THEN NULL WHEN gross_area <= 50 THEN 'Small'
  WHEN gross_area <= 100 THEN 'Medium' WHEN gross_area <= 200 THEN 'Large' ELSE 'XLarge' END AS size_category FROM entity"""))
def _(v):
    return v.entity.select(
        "entity_id", buckets.right_closed("gross_area", (50.0, 100.0, 200.0), SIZE, low=10.0).alias("size_category")
    )


SPAN = "date_diff('day', dt_start, dt_end)"


@query("P9_delay_severity", with_("entity", body=f"""
SELECT entity_id, {bucket_sql(SPAN, values.SEVERITY_EDGES, values.SEVERITY_LABELS)} AS severity FROM entity WHERE {SPAN} > 0"""))
def _(v):
    days = clean.span_days("dt_start", "dt_end")
    return v.entity.filter(days > 0).select("entity_id", buckets.severity(days).alias("severity"))


@query("P10_progress_bucket", with_("entity", body=f"""
SELECT entity_id, {bucket_sql(f'{SPAN} / CAST(2000 AS DOUBLE)', values.PROGRESS_EDGES, values.PROGRESS_LABELS)} AS progress FROM entity"""))
def _(v):
    return v.entity.select("entity_id", buckets.progress(clean.span_days("dt_start", "dt_end") / 2000.0).alias("progress"))


@query("P11_position_bucket", with_("entity", body=f"""
SELECT entity_id, {bucket_sql('x', values.POSITION5_EDGES, values.POSITION5_LABELS)} AS pos5,
  {bucket_sql('x', values.POSITION4_EDGES, values.POSITION4_LABELS)} AS pos4,
  {bucket_sql('x', values.POSITION3_EDGES, values.POSITION3_LABELS)} AS pos3
FROM (SELECT entity_id, gross_area / CAST(400 AS DOUBLE) AS x FROM entity)"""))
def _(v):
    df = v.entity.select("entity_id", (F.col("gross_area") / 400.0).alias("x"))
    return df.select("entity_id", *[buckets.position("x", k).alias(f"pos{k}") for k in (5, 4, 3)])


@query("P12_completion_buckets", with_("task", body=f"""
SELECT task_code, {bucket_sql('(1 - remaining / target) * 100', values.COMPLETION_EDGES, values.COMPLETION_LABELS)} AS completion,
  CASE WHEN remaining = 0 THEN 'completed' WHEN remaining = target THEN 'not_started'
   WHEN remaining > 0 AND remaining < target THEN 'active' ELSE 'unknown' END AS status FROM task"""))
def _(v):
    return v.task.select(
        "task_code",
        buckets.completion((1 - F.col("remaining") / F.col("target")) * 100).alias("completion"),
        buckets.completion_status("remaining", "target").alias("status"),
    )


@query("P13_category_by_prefix", with_(body="""
SELECT p_partkey, CASE WHEN t IS NULL THEN 'other' WHEN lower(t) LIKE 'econ%' THEN 'economy line' WHEN lower(t) LIKE 'st%' THEN 'standard line'
  ELSE lower(trim(t)) END AS category
FROM (SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL ELSE p_type END AS t FROM part)"""))
def _(v):
    t = F.when(F.col("p_size") >= 5, F.col("p_type"))
    df = v.table("part", "p_partkey", "p_type", "p_size").withColumn("t", t)
    prefixes = {"econ": "economy line", "st": "standard line"}
    return df.select("p_partkey", clean.canonical_by_prefix("t", prefixes).alias("category"))


@query("P14_status_simplified", with_("event", body="""
SELECT event_id, CASE WHEN lower(trade) IN ('view', 'click') THEN 'closed' WHEN lower(trade) = 'draft' THEN 'draft' ELSE 'open' END AS status FROM event"""))
def _(v):
    return v.event.select("event_id", clean.simple_status("trade", closed=("view", "click")).alias("status"))


@query("P15_code_prefix", with_(body="""
SELECT * FROM (SELECT p_partkey, trim(split_part(p_brand || ' - ' || p_type, ' - ', 1)) AS prefix FROM part)
WHERE prefix IN ('Brand#1', 'Brand#2', 'Brand#3')"""))
def _(v):
    full = F.concat("p_brand", F.lit(" - "), "p_type")
    df = v.table("part", "p_partkey", "p_brand", "p_type")
    return clean.keep_listed(df, "prefix", clean.code_prefix(full), ["Brand#1", "Brand#2", "Brand#3"]).select("p_partkey", "prefix")


@query("P16_label_whitelist", with_("event", body="""
SELECT event_id, upper(trim(trade)) AS label FROM event WHERE upper(trim(trade)) IN ('ERROR', 'CLICK')"""))
def _(v):
    return clean.keep_listed(v.event, "label", clean.label("trade"), ["ERROR", "CLICK"]).select("event_id", "label")


@query("P17_usable_code", with_(body="""
SELECT p_partkey, code FROM (SELECT p_partkey, upper(substr(p_type, 1, 1)) || CAST(p_size AS VARCHAR) ||
  CASE WHEN p_size % 7 = 0 THEN '?' ELSE '' END AS code FROM part)
WHERE regexp_matches(code, '^[A-Z][0-9]') AND length(code) <= 60 AND NOT regexp_matches(code, '[?!@#$%]')"""))
def _(v):
    p = v.table("part", "p_partkey", "p_type", "p_size")
    tail = F.when(F.col("p_size") % 7 == 0, "?").otherwise("")
    p = p.withColumn("code", F.concat(F.upper(F.substring("p_type", 1, 1)), F.col("p_size").cast("string"), tail))
    return p.filter(clean.usable_code("code")).select("p_partkey", "code")


@query("P18_lifecycle_percent", with_("event_full", body="""
SELECT event_id, round(date_diff('day', dt_start, created) * CAST(100 AS DOUBLE) / duration, 2) AS pct FROM event_full
WHERE created >= dt_start AND round(date_diff('day', dt_start, created) * CAST(100 AS DOUBLE) / duration, 2) BETWEEN 0 AND 90"""))
def _(v):
    df = v.event_full.filter(F.col("created") >= F.col("dt_start"))
    df = df.withColumn("pct", clean.lifecycle_percent("created", "dt_start", "duration", 2))
    return df.filter(F.col("pct").between(0, 90)).select("event_id", "pct")


# months_between counts whole months when both days match (or both are month ends), else 31-day fractions
def months_sql(a: str, b: str) -> str:
    return f"""(CASE WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b}))
      THEN CAST((year({a}) - year({b})) * 12 + month({a}) - month({b}) AS DOUBLE)
      ELSE round((year({a}) - year({b})) * 12 + month({a}) - month({b}) + (day({a}) - day({b})) / CAST(31 AS DOUBLE), 8) END)"""


SHARE_SQL = (
    f"least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), round({months_sql('dt_budget', 'dt_start')}, 0) / "
    f"greatest(CAST(trunc({months_sql('dt_end', 'dt_start')}) AS INTEGER), 1)))"
)


@query("P19_lifecycle_share", with_("ledger", "project", body=f"""
SELECT entity_id, dt_budget, round({SHARE_SQL}, 6) AS lifecycle_share, count(*) AS n
FROM ledger JOIN project USING (entity_id) GROUP BY ALL"""))
def _(v):
    # ledger rows are counted per day first, the share is computed once per (entity, day)
    days = v.ledger.groupBy("entity_id", "dt_budget").agg(F.count(F.lit(1)).alias("n"))
    df = days.join(v.project.select("entity_id", "dt_start", "dt_end"), "entity_id")
    return df.select(
        "entity_id", "dt_budget", F.round(clean.lifecycle_share("dt_budget", "dt_start", "dt_end"), 6).alias("lifecycle_share"), "n"
    )


@query("P20_span_position", with_("task", "project", body="""
SELECT task_code, round(date_diff('day', dt_start, task_start) / CAST(date_diff('day', dt_start, dt_end) AS DOUBLE), 3) + 0 AS pos,
  task_start FROM task JOIN project USING (entity_id)
WHERE date_diff('day', dt_start, dt_end) > 30
 AND round(date_diff('day', dt_start, task_start) / CAST(date_diff('day', dt_start, dt_end) AS DOUBLE), 3) BETWEEN 0 AND 1.2"""))
def _(v):
    p = v.project.select("entity_id", "dt_start", F.datediff("dt_end", "dt_start").alias("duration")).filter("duration > 30")
    df = v.task.join(p, "entity_id").withColumn("pos", clean.span_position("task_start", "dt_start", "duration"))
    return df.filter(F.col("pos").between(0, 1.2)).select("task_code", "pos", "task_start")


@query("P21_decile_bin", with_("entity", body="""
SELECT entity_id, floor(gross_area / 400 * 10) / 10 AS decile FROM entity WHERE gross_area / 400 BETWEEN 0 AND 1"""))
def _(v):
    x = F.col("gross_area") / 400
    return v.entity.filter(x.between(0, 1)).select("entity_id", buckets.decile(x).alias("decile"))


@query("P22_zone_labels", with_("event", body="""
SELECT event_id, CASE WHEN days < lo THEN 'pre_sow' WHEN days > hi THEN 'post_sow' ELSE 'during_sow' END AS zone
FROM event JOIN (SELECT trade, quantile_disc(days, 0.2) AS lo, quantile_disc(days, 0.9) AS hi FROM event GROUP BY 1) USING (trade)"""))
def _(v):
    cuts = group_stats(v.event, ["trade"], [Stats("days", {"lo": 0.2, "hi": 0.9})]).drop("n")
    return v.event.join(cuts, "trade").select("event_id", buckets.zone("days", "lo", "hi").alias("zone"))


@query("P23_durations", with_("entity", body="""
SELECT entity_id, date_diff('day', dt_start, dt_end) AS duration_days,
  CASE WHEN dt_end IS NOT NULL THEN date_diff('day', dt_start, dt_end) END AS span_if_known FROM entity"""))
def _(v):
    return v.entity.select(
        "entity_id",
        clean.span_days("dt_start", "dt_end").alias("duration_days"),
        clean.span_days_if("dt_start", "dt_end").alias("span_if_known"),
    )


@query("P24_validity_flags", with_("entity", body="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce(date_diff('day', dt_start, dt_end) >= 30, false)) AS n_not_valid_span,
  count(*) FILTER (WHERE NOT coalesce(n_floors >= 2, false)) AS n_not_valid_floors FROM entity"""))
def _(v):
    df = v.entity.withColumn("span", clean.span_days("dt_start", "dt_end"))
    df = clean.validity(df, {"valid_span": ("span", 30), "valid_floors": ("n_floors", 2)})
    return clean.validity_counts(df, ["valid_span", "valid_floors"])


@query("P25_pad_to_schema", with_(body="""
SELECT CAST(NULL AS VARCHAR) AS level, c_mktsegment AS sbu, count(*) AS n_projects, CAST(NULL AS DOUBLE) AS p25,
  round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY 2"""))
def _(v):
    stats = v.table("customer", "c_mktsegment", "c_acctbal").groupBy(F.col("c_mktsegment").alias("sbu")).agg(
        F.count(F.lit(1)).alias("n_observations"), F.round(F.avg("c_acctbal"), 4).alias("mean")
    )
    schema = {"level": "string", "sbu": "string", "n_projects": "long", "p25": "double", "mean": "double"}
    return clean.pad(stats, schema, renames={"n_observations": "n_projects"})


@query("P26_drop_shadowed_column", with_(body="""
SELECT o_orderkey, c_mktsegment AS sbu FROM orders JOIN customer ON o_custkey = c_custkey"""))
def _(v):
    left = v.table("orders", "o_orderkey", "o_custkey").select("o_orderkey", F.col("o_custkey").alias("cust"), F.lit("stale").alias("sbu"))
    right = v.table("customer", "c_custkey", "c_mktsegment").select(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("sbu"))
    return clean.drop_shadowed(left, right, ["cust"]).join(right, "cust").select("o_orderkey", "sbu")


INDEX = {1995: 100.0, 1996: 104.0, 1997: 109.0, 1998: 112.0, 1999: 118.0}


@query("P27_index_adjustment", with_("entity", body="""
SELECT entity_id, round(amt_contract * (CASE year(dt_start) WHEN 1995 THEN 100 WHEN 1996 THEN 104 WHEN 1997 THEN 109
 WHEN 1998 THEN 112 WHEN 1999 THEN 118 ELSE 109 END / CAST(109 AS DOUBLE)), 4) AS adj_contract FROM entity"""))
def _(v):
    factor = clean.index_factor(F.year("dt_start"), INDEX, base_year=1997)
    return v.entity.select("entity_id", F.round(F.col("amt_contract") * factor, 4).alias("adj_contract"))


@query("P28_log_features", with_("entity", body="""
SELECT entity_id, round(ln(greatest(amt_contract, 1)), 8) AS log_amt_contract, round(ln(1 + greatest(amt_contract, 0)), 8) AS log1p_amt_contract FROM entity"""))
def _(v):
    df = clean.log_features(v.entity.select("entity_id", "amt_contract"), ["amt_contract"])
    return df.select("entity_id", *[F.round(c, 8).alias(c) for c in ("log_amt_contract", "log1p_amt_contract")])


@query("P29_readable_key", with_("entity", body="""
SELECT entity_id, 'SYN-' || upper(substr(regexp_replace(sbu, '[^A-Za-z0-9]', '', 'g'), 1, 3)) || '-' || lpad(CAST(entity_id AS VARCHAR), 6, '0') AS key,
  CAST(entity_id AS VARCHAR) || CASE WHEN n_floors = 1 THEN '-000.01-BL' ELSE '-' || lpad(CAST(n_floors AS VARCHAR), 3, '0') || '.MO-RB' END AS code
FROM entity"""))
def _(v):
    return v.entity.select(
        "entity_id",
        clean.readable_key("SYN", "sbu", "entity_id").alias("key"),
        clean.version_code("entity_id", "n_floors", baseline=1).alias("code"),
    )


@query("P30_fingerprint", with_(body="""
SELECT c_custkey, substr(md5('{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}'), 1, 12) AS fp FROM customer"""))
def _(v):
    return v.table("customer", "c_custkey", "c_mktsegment", "c_nationkey").select(
        "c_custkey", clean.fingerprint(["c_nationkey", "c_mktsegment", "c_custkey"]).alias("fp")
    )


@query("P31_phase_class", with_(body="""
SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'early' WHEN p_brand LIKE 'Brand#2%' THEN 'mid' WHEN p_brand LIKE 'Brand#5%' THEN 'late' ELSE 'unknown' END AS phase FROM part"""))
def _(v):
    phases = {"early": ["Brand#1"], "mid": ["Brand#2"], "late": ["Brand#5"]}
    return v.table("part", "p_partkey", "p_brand").select("p_partkey", clean.phase_of("p_brand", phases).alias("phase"))
