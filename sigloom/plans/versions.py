"""Profile of versioned schedules: distinct versions, re-versioning counts, delays, timing, milestones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions import buckets, clean
from sigloom.operators.aggregates import bounds_json
from sigloom.operators.joins import share_of_all
from sigloom.operators.levels import Level, profile_fields, profile_levels
from sigloom.operators.quantiles import Stats, group_stats, percents
from sigloom.operators.setops import union_all

SEVEN = percents("p1", "p5", "p25", "median", "p75", "p95", "p99")
COUNT_LEVELS = (
    Level("SBU", ("sbu",)),
    Level("SBU_SIZE", ("sbu", "size_category"), 5, ("size_category",)),
    Level("SBU_CONTRACT", ("sbu", "contract_bucket"), 5, ("contract_bucket",)),
    Level("SBU_ASSET", ("sbu", "asset"), 5, ("asset",)),
)
DELAY_LEVELS = (
    Level("SBU", ("sbu",), 3),
    Level("SBU_SIZE", ("sbu", "size_category"), 3, ("size_category",)),
    Level("SBU_CONTRACT", ("sbu", "contract_bucket"), 3, ("contract_bucket",)),
    Level("GLOBAL", ()),
)
MILESTONE_LEVELS = (Level("SBU", ("sbu",)), Level("SBU_ASSET", ("sbu", "asset"), 5, ("sbu", "asset")))


def distinct_versions(
    df: DataFrame, entity: str = "entity_id", target: str = "target_date", start: str = "effective_from",
    end: str | None = None, carry: Sequence[str] = (), tie: Sequence[str] = (),
) -> DataFrame:
    """Snapshots with the same target date are one version; the first one's columns are kept.

    After this an entity has at most one row per target day, which bounds its windows.
    """
    order = F.struct(start, *tie)
    aggs = [F.min(start).alias(start)]
    if end:
        aggs.append(F.max(end).alias(end))
    if carry:
        aggs.append(F.min_by(F.struct(*carry), order).alias("__first"))
    out = df.filter(F.col(target).isNotNull()).groupBy(entity, target).agg(*aggs)
    names = [entity, target, start, *([end] if end else [])]
    out = out.select(*names, *[F.col(f"__first.{c}") for c in carry])
    w = W.partitionBy(entity).orderBy(start, target)
    return out.withColumns({"version_seq": F.row_number().over(w), "prev_target": F.lag(target).over(w)})


def rebaseline_counts(versions: DataFrame, entity: str = "entity_id") -> DataFrame:
    return versions.groupBy(entity).agg(F.max("version_seq").alias("n_versions")).withColumn(
        "n_rebaselines", F.col("n_versions") - 1
    )


def rebaseline_distribution(counts: DataFrame) -> DataFrame:
    per = counts.groupBy("n_rebaselines").agg(F.count(F.lit(1)).alias("n_projects"))
    return share_of_all(per, "n_projects", "pct_projects", 2)


def rebaseline_profile(counts: DataFrame, levels: Sequence[Level] = COUNT_LEVELS) -> DataFrame:
    stats = Stats("n_rebaselines", SEVEN, ("mean", "max"))
    return profile_levels(counts, levels, [stats], count="n_projects")


def version_delays(versions: DataFrame, target: str = "target_date") -> DataFrame:
    """Versions that push the target date out, with the days and the severity band."""
    out = versions.withColumn("delay_days", F.datediff(target, "prev_target")).filter("delay_days > 0")
    return out.withColumn("severity", buckets.severity("delay_days"))


def delay_profile(delays: DataFrame, levels: Sequence[Level] = DELAY_LEVELS) -> DataFrame:
    stats = Stats("delay_days", SEVEN, ("min", "max"))
    return profile_levels(delays, levels, [stats], common=["severity"], count="n_delays")


def timing_profile(delays: DataFrame, first: int = 1, last: int = 5, start: str = "effective_from") -> DataFrame:
    """When in the entity's span the 1st to 5th re-versioning happens. Needs dt_start and dt_end."""
    df = delays.withColumn("span", F.datediff("dt_end", "dt_start")).filter("span > 0")
    df = df.withColumn("timing", F.datediff(start, "dt_start") / F.col("span"))
    df = df.withColumn("rebaseline_number", F.col("version_seq") - 1)
    df = df.filter(F.col("rebaseline_number").between(first, last))
    out = group_stats(df, ["rebaseline_number"], [Stats("timing", SEVEN, ("mean",))], count="n_rebaselines")
    return out.withColumn("level", F.lit("TIMING"))


def milestones(df: DataFrame, ntp: str, tco: str, co: str, next_tco: str, min_span: int = 30, min_close: int = 14) -> DataFrame:
    """The three offsets with validity flags; rows stay."""
    df = df.withColumns(
        {
            "ntp_to_tco_days": clean.span_days(ntp, tco),
            "tco_to_co_days": clean.span_days_if(tco, co),
            "tco_to_next_tco_days": clean.span_days_if(tco, next_tco),
        }
    )
    return clean.validity(
        df, {"is_valid_ntp_tco": ("ntp_to_tco_days", min_span), "is_valid_tco_co": ("tco_to_co_days", min_close)}
    )


MILESTONE_FIELDS = ("ntp_to_tco_days", "tco_to_co_days", "tco_to_next_tco_days")


def milestone_profile(
    df: DataFrame, levels: Sequence[Level] = MILESTONE_LEVELS, fields: Sequence[str] = MILESTONE_FIELDS,
    quantiles: Sequence[str] = tuple(SEVEN), basics: Sequence[str] = ("min", "max", "mean", "stddev"),
) -> DataFrame:
    """Offsets of zero or more days; negative ones are a wrong date order and stay out."""
    kept = df.withColumns({f: F.when(F.col(f) >= 0, F.col(f)) for f in fields})
    out = profile_fields(kept, levels, fields, percents(*quantiles), tuple(basics)).filter("n_nonnull > 0")
    return out.drop("n_total").withColumnRenamed("n_nonnull", "n")


PROFILE_SCHEMA = {
    "level": "string", "sbu": "string", "asset": "string", "size_category": "string", "contract_bucket": "string",
    "field": "string", "n_projects": "long", "min": "double", "p1": "double", "p5": "double", "p25": "double",
    "median": "double", "p75": "double", "p95": "double", "p99": "double", "max": "double", "mean": "double",
    "stddev": "double",
}
CONSTRAINT_SCHEMA = {
    "level": "string", "sbu": "string", "asset": "string", "size_category": "string", "contract_bucket": "string",
    "field": "string", "n": "long", "bounds_json": "string",
}


def profile_table(counts: DataFrame, milestone: DataFrame) -> DataFrame:
    """Re-versioning counts and milestone offsets in one fixed schema."""
    a = counts.withColumn("field", F.lit("n_rebaselines"))
    return union_all(
        [clean.pad(a, PROFILE_SCHEMA), clean.pad(milestone, PROFILE_SCHEMA, renames={"n": "n_projects"})]
    )


def constraint_table(counts: DataFrame, delays: DataFrame, timing: DataFrame, milestone: DataFrame) -> DataFrame:
    """The bounds that generation draws from, as JSON maps."""
    named = {("p50" if n == "median" else n): n for n in SEVEN}
    parts = [
        counts.withColumns({"field": F.lit("n_rebaselines"), "bounds_json": bounds_json({**named, "max": "max", "mean": "mean"})})
        .withColumnRenamed("n_projects", "n"),
        delays.withColumns({"field": F.concat(F.lit("delay_"), "severity"), "bounds_json": bounds_json({**named, "min": "min", "max": "max"})})
        .withColumnRenamed("n_delays", "n"),
        timing.withColumns(
            {"field": F.concat(F.lit("timing_rebaseline_"), F.col("rebaseline_number").cast("string")), "bounds_json": bounds_json({**named, "mean": "mean"})}
        ).withColumnRenamed("n_rebaselines", "n"),
        milestone.withColumn("bounds_json", bounds_json({**named, "min": "min", "max": "max", "mean": "mean"})),
    ]
    return union_all([clean.pad(p, CONSTRAINT_SCHEMA) for p in parts])
