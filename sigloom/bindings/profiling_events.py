"""Event-log profile on the events and documents tables."""

from pyspark.sql import functions as F

from sigloom.bindings.aggregating import json_of, q_list, rounded
from sigloom.bindings.joining import EVENT_DAYS, event_days
from sigloom.bindings.registry import query
from sigloom.bindings.views import qd, with_
from sigloom.plans import events

FIVE = ("p10", "p25", "median", "p75", "p90")
FOUR = ("p25", "median", "p75", "p90")
MS = "round(avg({0}), 6) AS mean, round(stddev_samp({0}), 6) AS stddev"

LC = """
lc AS (SELECT * FROM (SELECT *, round(date_diff('day', dt_start, created) * CAST(100 AS DOUBLE) / duration, 2) AS pct FROM event_full WHERE created >= dt_start) WHERE pct BETWEEN 0 AND 165)"""


@query("D12_empirical_caps", with_("event_full", extra=LC, body=f"""
SELECT 'lifecycle' AS measure, count(*) AS n_events, {qd('pct', 0.99, 'p99')}, {qd('pct', 0.999, 'p999')} FROM lc WHERE pct <= 200
UNION ALL SELECT 'resolution', count(*), {qd('days', 0.99, 'p99')}, {qd('days', 0.999, 'p999')} FROM event_full WHERE days > 0"""))
def _(v):
    from sigloom.operators.setops import union_all

    lc = events.with_lifecycle(v.event_full)
    return union_all(
        [
            events.caps(lc, "lifecycle_pct", high=200).withColumn("measure", F.lit("lifecycle")),
            events.caps(v.event_full, "days", low=0).withColumn("measure", F.lit("resolution")),
        ]
    )


def counts(v):
    p = v.event_project.withColumn("size_category", F.when(F.col("duration") < 29, "short").otherwise("long"))
    return events.entity_counts(v.event).join(p.select("entity_id", "sbu", "size_category"), "entity_id")


CNT = """
c AS (SELECT p.sbu, CASE WHEN duration < 29 THEN 'short' ELSE 'long' END AS size_category, n_events FROM (SELECT entity_id, count(*) AS n_events FROM event GROUP BY 1) JOIN event_project p USING (entity_id))"""
CNT_COLS = f"count(*) AS n_projects, {q_list('n_events', FOUR)}, max(n_events) AS max, {MS.format('n_events')}"
CNT_SQL = f"""
SELECT 'SBU_SIZE' AS level, sbu, size_category, {CNT_COLS} FROM c GROUP BY sbu, size_category HAVING count(*) >= 5
UNION ALL SELECT 'SBU', sbu, NULL, {CNT_COLS} FROM c GROUP BY sbu HAVING count(*) >= 5 UNION ALL SELECT 'GLOBAL', NULL, NULL, {CNT_COLS} FROM c"""


@query("D13_event_counts", with_("event", "event_project", extra=CNT, body=CNT_SQL))
def _(v):
    return rounded(events.count_profile(counts(v)))


WEIGHTS_SQL = """
SELECT 'SBU' AS level, sbu, trade, count(*) AS n_events, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY sbu), 4) AS pct_of_sbu FROM event_full GROUP BY sbu, trade
UNION ALL SELECT 'GLOBAL', NULL, trade, count(*), round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 4) FROM event_full GROUP BY trade"""


@query("D14_trade_weights", with_("event_full", body=WEIGHTS_SQL))
def _(v):
    return events.trade_weights(v.event_full)


@query("D15_lifecycle_timing", with_("event_full", extra=LC, body=f"SELECT trade, count(*) AS n_events, {q_list('pct', FIVE)}, {MS.format('pct')} FROM lc GROUP BY 1 HAVING count(*) >= 5"))
def _(v):
    return rounded(events.lifecycle_profile(events.with_lifecycle(v.event_full)))


ZONES_SQL = """
SELECT trade, zone, count(*) AS n_events, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY trade), 4) AS pct_of_trade FROM (
 SELECT trade, CASE WHEN pct < lo THEN 'pre_sow' WHEN pct > hi THEN 'post_sow' ELSE 'during_sow' END AS zone FROM lc JOIN (SELECT trade, quantile_disc(pct, 0.2) lo, quantile_disc(pct, 0.9) hi FROM lc GROUP BY 1) USING (trade)) GROUP BY 1, 2"""


@query("D16_timing_zone_shares", with_("event_full", extra=LC, body=ZONES_SQL))
def _(v):
    return events.zone_shares(events.with_lifecycle(v.event_full))


RES_SQL = f"SELECT count(*) AS n_events, {q_list('days', FOUR)}, {MS.format('days')} FROM event WHERE trade = 'purchase' AND days BETWEEN 1 AND 300"


@query("D17_resolution_time", with_("event", body=RES_SQL))
def _(v):
    return rounded(events.resolution_profile(v.event, "days", F.col("trade") == "purchase"))


FLAG_SQL = "SELECT trade, count(*) AS n_events, round(count(*) FILTER (WHERE days > 60) * CAST(100 AS DOUBLE) / count(*), 4) AS pct_flag FROM event_full GROUP BY 1 HAVING count(*) >= 5"


@query("D18_flag_rate", with_("event_full", body=FLAG_SQL))
def _(v):
    return events.flag_rate(v.event_full, F.col("days") > 60)


STATUS_SQL = """
SELECT sbu, status_simplified, count(*) AS n_events, round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY sbu), 4) AS pct FROM
 (SELECT sbu, CASE WHEN lower(trade) IN ('view', 'click', 'purchase') THEN 'closed' WHEN lower(trade) = 'draft' THEN 'draft' ELSE 'open' END AS status_simplified FROM event_full) GROUP BY 1, 2"""


@query("D19_status_distribution", with_("event_full", body=STATUS_SQL))
def _(v):
    return events.status_distribution(v.event_full, "trade", ("view", "click", "purchase"))


SPIKE = EVENT_DAYS + """,
sp AS (SELECT unnest(generate_series(1, n)), a / CAST(b AS DOUBLE) AS r FROM (SELECT an.n,
 (SELECT sum(e.n) FROM ev e WHERE e.entity_id = an.entity_id AND e.day BETWEEN an.day - 6 AND an.day - 4) AS b,
 (SELECT sum(e.n) FROM ev e WHERE e.entity_id = an.entity_id AND e.day BETWEEN an.day AND an.day + 3) AS a FROM an) WHERE a / CAST(b AS DOUBLE) BETWEEN 0.5 AND 5)"""
SPIKE_SQL = f"SELECT count(*) AS n_events, {', '.join(f'round(quantile_disc(r, {p}), 8) AS {n}' for n, p in (('p25', 0.25), ('median', 0.5), ('p75', 0.75)))}, {MS.format('r')} FROM sp"


def spike(v):
    ev, an = event_days(v)
    return rounded(events.spike_profile(events.spike_ratios(ev, an, after=(0, 3), before=(-6, -4))), 6)


@query("D20_event_spike", with_("event", extra=SPIKE, body=SPIKE_SQL.replace(", 8)", ", 6)")))
def _(v):
    return spike(v)


SUB_SQL = """
SELECT trade, code, n AS n_events, round(n * CAST(100 AS DOUBLE) / t, 4) AS pct_of_trade FROM (SELECT *, sum(n) OVER (PARTITION BY trade) AS t FROM (SELECT trade, code, count(*) AS n FROM (SELECT p_type AS trade, upper(trim(unnest(string_split(p_name, ' ')))) AS code FROM part)
 WHERE regexp_matches(code, '^[A-Z]') AND length(code) <= 8 AND NOT regexp_matches(code, '[?!@#$%]') GROUP BY 1, 2)) WHERE n >= 5"""


def subcategories(v):
    p = v.table("part", "p_type", "p_name").select(F.col("p_type").alias("trade"), F.split("p_name", " ").alias("codes"))
    return events.subcategory_frequency(p, "codes", pattern="^[A-Z]", max_length=8)


@query("D21_subcategory_frequency", SUB_SQL)
def _(v):
    return subcategories(v)


POOL_SQL = """
SELECT trade, sbu, CAST(rank AS INTEGER) AS rank, doc_id, md5(text) AS text_md5, n_note FROM (SELECT source AS trade, lang AS sbu, text, doc_id, n_note, row_number() OVER (PARTITION BY source, lang ORDER BY length(text) DESC, doc_id) AS rank FROM
 (SELECT source, lang, text, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_note FROM documents WHERE length(text) > 50 GROUP BY 1, 2, 3)) WHERE rank <= 10"""


def pool(v):
    d = v.table("documents", "doc_id", "text", "lang", "source", "n_chars").select(
        F.col("source").alias("trade"), F.col("lang").alias("sbu"), "text", F.col("n_chars").cast("string").alias("note"), "doc_id"
    )
    return events.example_pool(d, ["trade", "sbu"], "text", "note", "doc_id")


@query("D22_example_pool", POOL_SQL)
def _(v):
    got = F.from_json("bounds_json", "lesson string, root_cause string")
    return pool(v).select(
        "trade", "sbu", "rank", "doc_id", F.md5(got["lesson"]).alias("text_md5"), got["root_cause"].cast("long").alias("n_note")
    )


def profile_parts(v):
    lc = events.with_lifecycle(v.event_full)
    return {
        ("n_events_per_entity", None): events.count_profile(counts(v)),
        ("trade_weight", None): events.trade_weights(v.event_full),
        ("lifecycle_timing_pct", "TRADE"): events.lifecycle_profile(lc),
        ("timing_zone_pct", "TRADE"): events.zone_shares(lc),
        ("resolution_days", "GLOBAL"): events.resolution_profile(v.event, "days", F.col("trade") == "purchase"),
        ("flag_pct", "TRADE"): events.flag_rate(v.event_full, F.col("days") > 60),
        ("status_distribution", "SBU"): events.status_distribution(v.event_full, "trade", ("view", "click", "purchase")),
        ("spike_ratio", "GLOBAL"): spike(v),
        ("code_frequency", "TRADE"): subcategories(v),
    }


def padded(field, level, cols, sql):
    """SELECT of the full profile schema around a part's SQL."""
    items = []
    for name, t in events.PROFILE_SCHEMA.items():
        if name == "field":
            items.append(f"'{field}' AS field")
        elif name == "level" and level:
            items.append(f"'{level}' AS level")
        elif name in cols:
            items.append(f"CAST({cols[name]} AS {'BIGINT' if t == 'long' else 'DOUBLE' if t == 'double' else 'VARCHAR'}) AS {name}")
        else:
            items.append(f"CAST(NULL AS {'BIGINT' if t == 'long' else 'DOUBLE' if t == 'double' else 'VARCHAR'}) AS {name}")
    return f"SELECT {', '.join(items)} FROM ({sql})"


def same(*names, **other):
    return {n: n for n in names} | other


PROFILE_SQL = " UNION ALL ".join(
    [
        padded("n_events_per_entity", None, same("level", "sbu", "size_category", "n_projects", "max", "p25", "median", "p75", "p90", "mean", "stddev"), CNT_SQL),
        padded("trade_weight", None, same("level", "sbu", "trade", "n_events", "pct_of_sbu"), WEIGHTS_SQL),
        padded("lifecycle_timing_pct", "TRADE", same("trade", "n_events", *FIVE, "mean", "stddev"), f"SELECT trade, count(*) AS n_events, {q_list('pct', FIVE)}, {MS.format('pct')} FROM lc GROUP BY 1 HAVING count(*) >= 5"),
        padded("timing_zone_pct", "TRADE", same("trade", "n_events", "pct_of_trade", status_simplified="zone"), ZONES_SQL),
        padded("resolution_days", "GLOBAL", same("n_events", *FOUR, "mean", "stddev"), RES_SQL),
        padded("flag_pct", "TRADE", same("trade", "n_events", "pct_flag"), FLAG_SQL),
        padded("status_distribution", "SBU", same("sbu", "status_simplified", "n_events", "pct"), STATUS_SQL),
        padded("spike_ratio", "GLOBAL", same("n_events", "p25", "median", "p75", "mean", "stddev"), SPIKE_SQL.replace(", 8)", ", 6)")),
        padded("code_frequency", "TRADE", same("trade", "code", "n_events", "pct_of_trade"), SUB_SQL),
    ]
)
ALL_CTES = CNT + "," + LC + "," + SPIKE


@query("D23_event_profile_table", with_("event_full", extra=ALL_CTES, body=PROFILE_SQL))
def _(v):
    return rounded(events.profile_table(profile_parts(v)))


@query("D24_event_constraints", with_("event_full", extra=ALL_CTES, body=f"""
SELECT level, 'n_events_per_entity' AS field, sbu, size_category, NULL AS trade, n_projects, NULL AS n_events, {json_of([(c, c) for c in FOUR])} AS bounds_json FROM ({CNT_SQL})
UNION ALL SELECT 'TRADE', 'lifecycle_timing_pct', NULL, NULL, trade, NULL, n_events, {json_of([(c, c) for c in FIVE])} FROM (SELECT trade, count(*) AS n_events, {q_list('pct', FIVE)} FROM lc GROUP BY 1 HAVING count(*) >= 5)
UNION ALL SELECT 'GLOBAL', 'resolution_days', NULL, NULL, NULL, NULL, n_events, {json_of([(c, c) for c in FOUR])} FROM ({RES_SQL})"""))
def _(v):
    lc = events.with_lifecycle(v.event_full)
    return events.constraint_table(
        {
            ("n_events_per_entity", None): (events.count_profile(counts(v)), FOUR),
            ("lifecycle_timing_pct", "TRADE"): (events.lifecycle_profile(lc), FIVE),
            ("resolution_days", "GLOBAL"): (events.resolution_profile(v.event, "days", F.col("trade") == "purchase"), FOUR),
        }
    )
