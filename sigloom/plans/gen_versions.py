"""Versioned-schedule generator: re-versioning count, timings, delays, slowly changing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import clean, draws, values
from sigloom.functions.draws import let
from sigloom.operators.lookup import fallback, lookups
from sigloom.operators.ordered import spread
from sigloom.session import cut_lineage

MIN_CLOSE_DAYS = 14
MIN_DELAY = 7
SLACK_SHARE = 0.9
SLACK_MARGIN = 0.20
BASELINE_LEAD_DAYS = 90
GAP, LAST_TIMING = 0.05, 0.95
NEXT_TARGET_SHARE = 0.35


#: prefix -> field of the profile and the statistics that its draw reads
COUNT = {"__": ("n_rebaselines", ["mean", "p99", "max"])}
OFFSETS = {"__co_": ("tco_to_co_days", ["p25", "median", "p75"]), "__nx_": ("tco_to_next_tco_days", ["p25", "median", "p75"])}


def rebaseline_count(entities: DataFrame, profile: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Poisson count with the group's mean, capped at its p99 and maximum."""
    return _counted(lookups(entities, profile, COUNT, count="n_projects"), entity).select(*entities.columns, "n_rebaselines")


def _counted(got: DataFrame, entity: str) -> DataFrame:
    cap = F.least("__p99", "__max")
    n = draws.poisson(draws.uniform([entity], "n_rebaselines"), F.coalesce("__mean", F.lit(0.0)), cap)
    return got.withColumn("n_rebaselines", n)


def milestone_offset(keys, purpose: str, p25, median, p75, floor: int | None = None) -> Column:
    """Whole days from a triangular draw: floored, then jittered; NULL quartiles give the floor.

    A side that equals the median is opened by 5 days, unless both do.
    """
    m = F.col(median)
    lo = F.when((F.col(p25) == m) & (F.col(p75) != m), m - 5).otherwise(F.col(p25))
    hi = F.when((F.col(p75) == m) & (F.col(p25) != m), m + 5).otherwise(F.col(p75))
    v = draws.triangular(draws.uniform(keys, purpose), lo, median, hi)
    v = F.coalesce(v, F.lit(float(floor or 0)))
    if floor is not None:
        v = F.greatest(v, F.lit(float(floor)))
    v = v * (1.0 + draws.uniform(keys, purpose + ":jitter", -0.06, 0.06))
    return v.cast("int")


def with_offsets(entities: DataFrame, profile: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Days from target to close-out, and to a next target for about a third of the entities."""
    return _offset(lookups(entities, profile, OFFSETS, count="n_projects"), entity).select(*entities.columns, "co_offset", "next_offset")


def _offset(got: DataFrame, entity: str) -> DataFrame:
    co = milestone_offset([entity], "co", "__co_p25", "__co_median", "__co_p75", MIN_CLOSE_DAYS)
    nxt = milestone_offset([entity], "next", "__nx_p25", "__nx_median", "__nx_p75")
    has_next = draws.chance([entity], "has_next", NEXT_TARGET_SHARE)
    return got.withColumns({"co_offset": co, "next_offset": F.when(has_next, nxt)})


def delay_days(raw: Column, slack: Column, p95: Column, p99: Column, u_slack: Column, u_over: Column, u_jitter: Column, known: Column, default: Column) -> Column:
    """Delay within the slack that is left, softly capped at p95 and hard at p99, at least 7 days."""
    limit = slack * SLACK_SHARE
    v = F.when((slack > 0) & (raw > limit), limit * (1.0 + u_slack * SLACK_MARGIN)).otherwise(raw)
    v = F.when(v > p95, p95 * (1.0 + u_over * SLACK_MARGIN)).otherwise(v * (1.0 + (u_jitter * 2 - 1) * 0.06))
    v = F.greatest(F.least(v, p99), F.lit(float(MIN_DELAY)))
    return F.when(known, v).otherwise(default).cast("int")


def version_draws(entities: DataFrame, constraints: DataFrame, entity: str = "entity_id") -> DataFrame:
    """One row per re-versioning: raw timing, delay category and everything its delay needs."""
    rows = entities.filter("n_rebaselines > 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n_rebaselines"))))
    key = [entity, "i"]
    timing = constraints.filter(F.col("level") == "TIMING").select(
        F.regexp_extract("field", "([0-9]+)$", 1).cast("int").alias("__slot"), F.from_json("bounds_json", "map<string,double>").alias("__tb")
    )
    rows = rows.withColumn("__slot", F.least(F.col("i"), F.lit(5))).join(timing, "__slot", "left")
    fixed = F.create_map(*[x for k, v in values.TIMING_DEFAULTS.items() for x in (F.lit(k), F.lit(v))])
    t = draws.triangular(draws.uniform(key, "timing"), F.col("__tb")["p25"], F.col("__tb")["p50"], F.col("__tb")["p75"])
    t = F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), t)), F.try_element_at(fixed, F.col("__slot")), F.lit(0.5))
    category = draws.categorical(draws.uniform(key, "category"), values.DELAY_SHARES, None)
    rows = rows.withColumns({"t": t, "category": category, "field": F.concat(F.lit("delay_"), category)})
    delay = constraints.filter(F.col("field").startswith("delay_")).withColumnsRenamed({"field": "__f"}).withColumn("field", F.lit("delay"))
    got = fallback(
        rows.withColumnRenamed("field", "__f"), delay, "delay", ["bounds_json"], count=None, prefix="__d_", extra_keys=["__f"],
        chain=(("SBU_CONTRACT", ("sbu", "contract_bucket")), ("SBU_SIZE", ("sbu", "size_category")), ("SBU", ("sbu",)), ("GLOBAL", ())),
    )
    b = F.from_json("__d_bounds_json", "map<string,double>")
    mid = F.create_map(*[x for k, v in values.DELAY_MIDPOINTS.items() for x in (F.lit(k), F.lit(v))])
    got = got.withColumn("__b", b)
    raw = draws.triangular(draws.uniform(key, "delay"), F.col("__b")["p25"], F.col("__b")["p50"], F.col("__b")["p75"])
    return got.select(
        entity, "i", "t", "category", F.col("__b").isNotNull().alias("known"), raw.alias("raw"),
        F.col("__b")["p95"].alias("p95"), F.col("__b")["p99"].alias("p99"), F.element_at(mid, F.col("category")).alias("fixed_days"),
        *[draws.uniform(key, f"delay:{n}").alias(f"u_{n}") for n in ("slack", "over", "jitter")],
    )


def _fold(rows: Column, start: Column, end: Column, span: Column) -> Column:
    """Walk the sorted draws: space the timings, date them, size the delays by the slack left."""
    item = "struct<i:int,date:date,target:date,delay:int,category:string>"
    zero = F.struct(
        F.lit(0.0).alias("t"), F.lit(None).cast("date").alias("date"), end.alias("target"), F.lit(0).alias("i"),
        F.array().cast(f"array<{item}>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        t = F.least(F.lit(LAST_TIMING), F.greatest(x["t"], acc["t"] + GAP))
        spaced = F.struct(t.alias("t"), F.date_add(start, (span * t).cast("int")).alias("at"))
        return let(spaced, lambda s: let(
            F.when(acc["date"].isNotNull() & (s["at"] <= acc["date"]), F.date_add(acc["date"], 1)).otherwise(s["at"]),
            lambda at: let(F.datediff(acc["target"], at), lambda left: let(
                F.when(left <= 0, 30).otherwise(left).cast("double"), lambda slack: let(delay(x, slack), lambda days: dated(acc, x, s["t"], at, days)))),
        ))

    def delay(x: Column, slack: Column) -> Column:
        return delay_days(x["raw"], slack, x["p95"], x["p99"], x["u_slack"], x["u_over"], x["u_jitter"], x["known"], x["fixed_days"])

    def dated(acc: Column, x: Column, t: Column, at: Column, days: Column) -> Column:
        target, i = F.date_add(acc["target"], days), acc["i"] + 1
        row = F.struct(i.alias("i"), at.alias("date"), target.alias("target"), days.alias("delay"), x["category"].alias("category"))
        return F.struct(t.alias("t"), at.alias("date"), target.alias("target"), i.alias("i"), F.concat(acc["out"], F.array(row)).alias("out"))

    return F.aggregate(rows, zero, step)["out"]


def generate(entities: DataFrame, profile: DataFrame, constraints: DataFrame, entity: str = "entity_id") -> DataFrame:
    """All versions of every entity. Entities bring sbu, asset, size_category, contract_bucket, dt_start, dt_end.

    The chain of an entity is an array of at most 64 draws, folded in one expression.
    """
    known = spread(lookups(entities, profile, COUNT | OFFSETS, count="n_projects"), entity)
    drawn = _offset(_counted(known, entity), entity)
    # the draws are made once: what follows reads the entities twice
    base = cut_lineage(drawn.select(*entities.columns, "n_rebaselines", "co_offset", "next_offset"))
    d = version_draws(base, constraints, entity)
    cols = [c for c in d.columns if c not in (entity, "t")]
    arr = d.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct("t", *cols))).alias("__draws"))
    df = base.join(arr, entity, "left")
    span = F.datediff("dt_end", "dt_start")
    folded = F.when(F.col("n_rebaselines") > 0, _fold(F.col("__draws"), F.col("dt_start"), F.col("dt_end"), span))
    first = F.struct(
        F.lit(0).alias("i"), F.date_sub("dt_start", BASELINE_LEAD_DAYS).alias("date"), F.col("dt_end").alias("target"),
        F.lit(0).alias("delay"), F.lit(None).cast("string").alias("category"),
    )
    df = df.withColumn("__v", F.coalesce(F.concat(F.array(first), folded), F.array(first)))
    ends = F.transform("__v", lambda x, k: F.when(
        k + 1 < F.size("__v"), F.greatest(x["date"], F.date_sub(F.get(F.col("__v"), k + 1)["date"], 1))
    ).otherwise(F.lit(values.OPEN_END).cast("date")))
    df = df.withColumn("__e", ends).select(entity, "n_rebaselines", "dt_start", "dt_end", "co_offset", "next_offset", F.posexplode(F.arrays_zip("__v", "__e")).alias("pos", "x"))
    v = F.col("x.__v")
    return df.select(
        entity,
        clean.version_code(entity, "pos").alias("code"),
        F.col("pos").alias("version"),
        F.col("dt_start").alias("dt_ntp"),
        v["target"].alias("dt_tco"),
        F.date_add(v["target"], F.col("next_offset")).alias("dt_next_tco"),
        F.date_add(v["target"], F.col("co_offset")).alias("dt_co"),
        (F.col("n_rebaselines") + 1 - F.col("pos")).alias("n_recent"),
        v["date"].alias("effective_from"),
        F.col("x.__e").alias("effective_to"),
        (F.col("pos") == F.col("n_rebaselines")).alias("is_active"),
        v["delay"].alias("delay_days"),
        v["category"].alias("delay_category"),
        F.col("dt_end").alias("dt_tco_original"),
    )


def rebaseline_events(versions: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Metadata of every version after the baseline."""
    return versions.filter("version > 0").select(
        entity, F.col("version").alias("rebaseline_number"), F.col("effective_from").alias("dt_rebaseline"), "dt_tco_original",
        F.col("dt_tco").alias("dt_tco_revised"), "delay_days", "delay_category", F.lit(None).cast("string").alias("primary_delayed_sow"),
        F.lit(None).cast("int").alias("n_sows_impacted"),
    )


def self_check(versions: DataFrame, required, entity: str = "entity_id") -> DataFrame:
    """Nulls in required columns, falling targets, reversed windows, versions per entity: one row."""
    from sigloom.operators.windows import regressions

    falls = regressions(versions.select(entity, "effective_from", "code", "dt_tco"), [entity], ["effective_from", "code"], "dt_tco")
    per = versions.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_active").alias("a"))
    sizes = per.agg(
        F.struct(
            F.count(F.lit(1)).alias("n_entities"), F.count_if(F.col("n") == 1).alias("n_single"), F.round(F.avg("n"), 4).alias("avg"), F.count_if(F.col("a") != 1).alias("bad")
        )
    ).scalar()
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    row = versions.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(missing).alias("n_missing"), F.count_if(F.col("effective_to") < F.col("effective_from")).alias("n_reversed")
    )
    return row.select(
        "n_rows", "n_missing", "n_reversed", falls.agg(F.count(F.lit(1))).scalar().alias("n_falling"), sizes["n_entities"].alias("n_entities"),
        sizes["n_single"].alias("n_single_version"), sizes["avg"].alias("avg_versions"), sizes["bad"].alias("n_not_one_active"),
    )
