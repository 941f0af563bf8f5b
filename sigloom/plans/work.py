"""Profile of work packages: windows, order, overlap, concurrency, tasks, completion, snapshots.

Columns by role: entity_id, sow (work package), task_code, task_start, task_end, effective_from,
target and remaining duration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions import buckets, clean
from sigloom.operators.aggregates import bounds_json, pivot_shares
from sigloom.operators.joins import active_on_spine
from sigloom.operators.levels import Level, counted_levels, profile_levels
from sigloom.operators.quantiles import Stats, first_of, group_stats, percents
from sigloom.operators.setops import union_all

FULL = percents("p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99")
SHORT = percents("p5", "p10", "p25", "median", "p75", "p90", "p95")
FIVE = percents("p10", "p25", "median", "p75", "p90")
THREE = percents("p25", "median", "p75")
ENTITY_LEVELS = (
    Level("SBU", ("sbu",), 5),
    Level("SBU_SIZE", ("sbu", "size_category"), 5, ("size_category",)),
    Level("SBU_CONTRACT", ("sbu", "contract_bucket"), 5, ("contract_bucket",)),
)
SOW_LEVELS = (Level("SOW_TYPE", ("sow",), 10), Level("SOW_SBU", ("sow", "sbu"), 5))


def labelled(tasks: DataFrame, sow: str = "sow") -> DataFrame:
    return tasks.filter(F.col(sow).isNotNull() & (F.trim(F.col(sow)) != ""))


def covered_entities(
    tasks: DataFrame, entity: str = "entity_id", sow: str = "sow", min_percent: float = 75.0, min_tasks: int = 100, min_labels: int = 5
) -> DataFrame:
    """Entities whose tasks are labelled well enough to be profiled, with the evidence."""
    out = tasks.groupBy(entity).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count(sow).alias("tasks_with_label"),
        F.count_distinct(sow).alias("n_labels"),
    )
    out = out.withColumn("pct_coverage", F.round(F.col("tasks_with_label") * 100.0 / F.col("total_tasks"), 2))
    return out.filter(
        (F.col("pct_coverage") >= min_percent) & (F.col("total_tasks") >= min_tasks) & (F.col("n_labels") >= min_labels)
    )


def windows(tasks: DataFrame, entity: str, sow: str, start: str, end: str, keep: Sequence[str] = ()) -> DataFrame:
    """First start, last end and days of each work package of an entity; reversed ones drop out."""
    out = (
        labelled(tasks, sow).filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        .groupBy(entity, sow, *keep).agg(F.min(start).alias("sow_start"), F.max(end).alias("sow_finish"))
    )
    return out.withColumn("sow_days", F.datediff("sow_finish", "sow_start")).filter("sow_days >= 0")


def sequence(wins: DataFrame, entity: str = "entity_id", sow: str = "sow") -> DataFrame:
    """Order of the work packages; an entity has at most one row per label of the vocabulary."""
    return wins.withColumn("seq", F.row_number().over(W.partitionBy(entity).orderBy("sow_start", sow)))


def sow_counts(tasks: DataFrame, entity: str = "entity_id", sow: str = "sow") -> DataFrame:
    return labelled(tasks, sow).groupBy(entity).agg(F.count_distinct(sow).alias("n_sows"))


def sow_count_profile(counts: DataFrame, levels: Sequence[Level] = ENTITY_LEVELS) -> DataFrame:
    return profile_levels(counts, levels, [Stats("n_sows", FULL, ("min", "max", "mean", "stddev"))], count="n_projects")


def sequence_profile(seq: DataFrame, entity: str = "entity_id") -> DataFrame:
    levels = (Level("SOW_SBU", ("sow", "sbu"), 5), Level("GLOBAL", ("sow",), 10))
    marked = seq.withColumns({"__of_sow": first_of(["sow"], entity), "__of_unit": first_of(["sow", "sbu"], entity)})
    n = F.when(F.grouping("sbu") == 1, F.count_if("__of_sow")).otherwise(F.count_if("__of_unit"))
    return profile_levels(
        marked, levels, [Stats("seq", FIVE, ("mean", "stddev", "min", "max"))], count="n_occurrences", extra={"n_projects": n}, min_on="n_projects"
    )


def sow_frequency(seq: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Percent of an SBU's entities that have the work package."""
    per = seq.groupBy("sbu", "sow").agg(F.count_distinct(entity).alias("n_projects"), F.count(F.lit(1)).alias("n_occurrences"))
    total = seq.groupBy("sbu").agg(F.count_distinct(entity).alias("n_total"))
    return per.join(total, "sbu").withColumn("pct_projects", F.round(F.col("n_projects") * 100.0 / F.col("n_total"), 2))


def task_count_profile(tasks: DataFrame, levels: Sequence[Level] = SOW_LEVELS, entity: str = "entity_id") -> DataFrame:
    per = labelled(tasks).groupBy(entity, "sow", "sbu").agg(F.count_distinct("task_code").alias("n_tasks"))
    return counted_levels(per, levels, Stats("n_tasks", SHORT, ("mean", "min", "max")), count="n_observations")


def duration_profile(wins: DataFrame, levels: Sequence[Level] = SOW_LEVELS) -> DataFrame:
    return profile_levels(wins, levels, [Stats("sow_days", SHORT, ("mean", "min", "max"))], count="n_observations")


def consecutive(seq: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Each work package with its successor and the days they share."""
    nxt = F.lead(F.struct("sow", "sow_start", "sow_finish")).over(W.partitionBy(entity).orderBy("seq"))
    out = seq.withColumn("__next", nxt).filter("__next IS NOT NULL")
    out = out.withColumns(
        {
            "sow_first": F.col("sow"),
            "sow_second": F.col("__next.sow"),
            "overlap_days": F.datediff("sow_finish", F.col("__next.sow_start")),
        }
    )
    pct = F.when(F.col("sow_days") > 0, F.round(F.col("overlap_days") / F.col("sow_days") * 100.0, 2))
    return out.withColumn("overlap_pct", pct).select(entity, "sow_first", "sow_second", "overlap_days", "overlap_pct")


def overlap_profile(pairs: DataFrame, min_pairs: int = 5) -> DataFrame:
    levels = (Level("GENERAL", ()), Level("PAIR", ("sow_first", "sow_second"), min_pairs))
    stats = [Stats("overlap_days", THREE, ("mean",), suffix="_days"), Stats("overlap_pct", THREE, ("mean",), suffix="_pct")]
    out = profile_levels(pairs, levels, stats, count="n_transitions")
    pair = F.when(F.col("level") == "GENERAL", "all_pairs").otherwise(F.concat("sow_first", F.lit(" → "), "sow_second"))
    return out.withColumn("sow_pair", pair)


def concurrency(seq: DataFrame, entity: str = "entity_id", step_days: int = 7) -> DataFrame:
    """Largest, mean and quartile number of open work packages on a weekly spine, per entity."""
    spine = active_on_spine(seq, entity, "sow_start", "sow_finish", step_days=step_days)
    st = Stats("n_active", {"p75_concurrent": 0.75, "median_concurrent": 0.5, "p25_concurrent": 0.25}, ("max", "mean"), names={"max": "max_concurrent", "mean": "avg_concurrent"})
    return group_stats(spine, [entity], [st], count="n_samples")


def concurrency_profile(per_entity: DataFrame) -> DataFrame:
    levels = (Level("SBU", ("sbu",), 5), Level("SBU_SIZE", ("sbu", "size_category"), 5, ("size_category",)))
    stats = [
        Stats("max_concurrent", FIVE, ("mean", "stddev"), suffix="_max"),
        Stats("avg_concurrent", FIVE, ("mean", "stddev"), suffix="_avg"),
    ]
    return profile_levels(per_entity, levels, stats, count="n_projects")


def task_durations(tasks: DataFrame) -> DataFrame:
    out = labelled(tasks).withColumn("task_days", F.datediff("task_end", "task_start"))
    return out.filter("task_days >= 0")


def task_duration_profile(tasks: DataFrame, min_tasks: int = 100) -> DataFrame:
    return group_stats(task_durations(tasks), ["sow"], [Stats("task_days", FIVE, ("mean",))], count="n_tasks", min_rows=min_tasks)


def task_offsets(tasks: DataFrame, wins: DataFrame, entity: str = "entity_id") -> DataFrame:
    """Start of each task as a share of its work package's window, kept within [0, 1]."""
    w = wins.filter("sow_days > 0").select(entity, "sow", "sow_start", "sow_days")
    out = labelled(tasks).join(w, [entity, "sow"])
    out = out.withColumn("offset", F.datediff("task_start", "sow_start") / F.col("sow_days"))
    return out.filter(F.col("offset").between(0, 1))


def start_shape_profile(offsets: DataFrame, min_tasks: int = 100) -> DataFrame:
    return group_stats(offsets, ["sow"], [Stats("offset", FIVE, ("mean", "stddev"))], count="n_observations", min_rows=min_tasks)


def duration_by_position(offsets: DataFrame, min_tasks: int = 50) -> DataFrame:
    df = offsets.withColumns({"task_days": F.datediff("task_end", "task_start"), "position": buckets.position("offset", 3)})
    return group_stats(
        df.filter("task_days >= 0"), ["sow", "position"], [Stats("task_days", FIVE, ("mean", "min", "max"))], count="n_tasks", min_rows=min_tasks
    )


def completion_distribution(tasks: DataFrame, digits: int = 2) -> DataFrame:
    df = labelled(tasks).filter(F.col("target").isNotNull())
    df = df.select("sow", buckets.completion_status("remaining", "target").alias("status"))
    return pivot_shares(df, "sow", "status", ["completed", "active", "not_started"], digits=digits)


def early_start_rate(tasks: DataFrame, min_tasks: int = 100, digits: int = 2) -> DataFrame:
    early = F.count_if(F.col("start_source") == "early start")
    out = labelled(tasks).filter(F.col("start_source").isNotNull()).groupBy("sow").agg(
        F.count(F.lit(1)).alias("n_tasks"), early.alias("n_early_start")
    )
    return out.filter(F.col("n_tasks") >= min_tasks).withColumn(
        "pct_early_start", F.round(F.col("n_early_start") * 100.0 / F.col("n_tasks"), digits)
    )


def snapshots(tasks: DataFrame, entity: str = "entity_id", at: str = "effective_from") -> DataFrame:
    """One row per work package and snapshot day."""
    out = labelled(tasks).groupBy(entity, "sow", at).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.count_if(F.col("remaining") == 0).alias("n_completed"),
        F.min("task_start").alias("sow_start"),
        F.max("task_end").alias("sow_finish"),
    )
    return out.withColumn("pct_complete", F.round(F.col("n_completed") * 100.0 / F.greatest("n_tasks", F.lit(1)), 2))


def _placed(snaps: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """Join the entity's dates; spans of 30 days or less drop out."""
    e = entities.withColumn("span", F.datediff("dt_end", "dt_start")).filter("span > 30")
    return snaps.join(e, entity)


def completion_progression(snaps: DataFrame, entities: DataFrame, entity: str = "entity_id", at: str = "effective_from") -> DataFrame:
    """Percent complete by lifecycle progress and position of the work package."""
    df = _placed(snaps, entities.select(entity, "sbu", "dt_start", "dt_end"), entity)
    df = df.withColumns(
        {"timing": clean.span_position(at, "dt_start", "span"), "pos": clean.span_position("sow_start", "dt_start", "span")}
    ).filter(F.col("timing").between(0, 1.2) & F.col("pos").between(0, 1.2))
    df = df.withColumns({"progress": buckets.progress("timing"), "position": buckets.position("pos", 5)})
    levels = (Level("SBU", ("sbu",), 5), Level("GLOBAL", (), 10))
    return counted_levels(
        df, levels, Stats("pct_complete", THREE, suffix="_complete"), common=["progress", "position"], count="n_observations", mean=("avg_pct_complete", 2)
    )


def count_change_profile(snaps: DataFrame, entities: DataFrame, entity: str = "entity_id", at: str = "effective_from", min_base: int = 5, digits: int = 3) -> DataFrame:
    """Task count of the next snapshot over this one's, within [0.2, 5]."""
    nxt = F.lead("n_tasks").over(W.partitionBy(entity, "sow").orderBy(at))
    df = snaps.withColumn("n_next", nxt).filter(F.col("n_next").isNotNull() & (F.col("n_tasks") >= min_base))
    df = df.withColumn("ratio", F.round(F.col("n_next") / F.col("n_tasks").cast("double"), 3)).filter(F.col("ratio").between(0.2, 5.0))
    df = df.join(entities.select(entity, "sbu"), entity)
    return counted_levels(
        df, (Level("SBU", ("sbu",), 5), Level("GLOBAL", ())), Stats("ratio", FIVE, suffix="_ratio"), count="n_transitions", mean=("avg_ratio", digits)
    )


def date_shift_profile(snaps: DataFrame, entities: DataFrame, entity: str = "entity_id", at: str = "effective_from", min_rows: int = 10, digits: int = 1) -> DataFrame:
    """How dates move to the next snapshot, by completion and position. The next snapshot is a
    `lead` over the chain, not a join of every later one."""
    nxt = F.lead(F.struct("sow_start", "sow_finish")).over(W.partitionBy(entity, "sow").orderBy(at))
    df = snaps.withColumn("__n", nxt).filter("__n IS NOT NULL")
    df = df.withColumns(
        {
            "finish_shift": F.datediff("__n.sow_finish", "sow_finish"),
            "start_shift": F.datediff("__n.sow_start", "sow_start"),
            "duration_change": F.datediff("__n.sow_finish", "__n.sow_start") - F.datediff("sow_finish", "sow_start"),
        }
    )
    df = _placed(df, entities.select(entity, "dt_start", "dt_end"), entity)
    df = df.withColumn("pos", clean.span_position("sow_start", "dt_start", "span"))
    df = df.withColumns({"completion": buckets.completion("pct_complete"), "position": buckets.position("pos", 4)})
    extra = {f"avg_{c}": F.round(F.avg(c), digits) for c in ("finish_shift", "start_shift", "duration_change")}
    stats = [
        Stats("finish_shift", THREE, suffix="_finish_shift"),
        Stats("start_shift", percents("median"), suffix="_start_shift"),
        Stats("duration_change", percents("median"), suffix="_duration_change"),
    ]
    return group_stats(df, ["completion", "position"], stats, count="n_observations", extra=extra, min_rows=min_rows)


PROFILE_SCHEMA = {
    "level": "string", "sbu": "string", "size_category": "string", "contract_bucket": "string", "sow": "string",
    "field": "string", "n_projects": "long", "min": "double", "p1": "double", "p5": "double", "p10": "double",
    "p25": "double", "median": "double", "p75": "double", "p90": "double", "p95": "double", "p99": "double",
    "max": "double", "mean": "double", "stddev": "double",
}
CONSTRAINT_SCHEMA = {
    "level": "string", "sbu": "string", "size_category": "string", "contract_bucket": "string", "sow": "string",
    "field": "string", "n": "long", "bounds_json": "string",
}


def profile_table(parts: dict[str, DataFrame]) -> DataFrame:
    """Profiles by field name in one schema; whatever the count is called, it becomes n_projects."""
    out = []
    for name, df in parts.items():
        count = next(c for c in ("n_projects", "n_observations", "n_tasks", "n_transitions", "n") if c in df.columns)
        df = df.withColumn("field", F.lit(name))
        df = df if "level" in df.columns else df.withColumn("level", F.lit("SOW_TYPE"))
        out.append(clean.pad(df, PROFILE_SCHEMA, renames={count: "n_projects"}))
    return union_all(out)


def split_concurrency(profile: DataFrame) -> dict[str, DataFrame]:
    """The two measures of the concurrency profile as two field profiles."""
    names = (*FIVE, "mean", "stddev")
    keep = [c for c in ("level", "sbu", "size_category", "n_projects") if c in profile.columns]
    return {
        f"{k}_concurrent_sows": profile.select(*keep, *[F.col(f"{n}_{k}").alias(n) for n in names]) for k in ("max", "avg")
    }


def constraint_table(parts: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Field name -> (profile, columns to keep as bounds)."""
    out = []
    for name, (df, cols) in parts.items():
        count = next(c for c in ("n_projects", "n_observations", "n_tasks", "n_transitions", "n") if c in df.columns)
        df = df.withColumns({"field": F.lit(name), "bounds_json": bounds_json(list(cols))})
        df = df if "level" in df.columns else df.withColumn("level", F.lit("SOW_TYPE"))
        out.append(clean.pad(df, CONSTRAINT_SCHEMA, renames={count: "n"}))
    return union_all(out)
