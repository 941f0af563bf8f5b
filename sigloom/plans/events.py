"""Profile of an event log: counts, mixes, timing, resolution, spikes, example pool.

Columns by role: entity_id, sbu, size_category, created, trade, dt_start, duration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import buckets, clean
from sigloom.operators.aggregates import bounds_json
from sigloom.operators.joins import share_of_all, share_of_group, window_counts
from sigloom.operators.levels import Level, profile_levels
from sigloom.operators.ordered import one_key, ordered
from sigloom.operators.quantiles import Stats, group_stats, percents
from sigloom.operators.setops import union_all
from sigloom.operators.windows import top_k

FIVE = percents("p10", "p25", "median", "p75", "p90")
FOUR = percents("p25", "median", "p75", "p90")
COUNT_LEVELS = (
    Level("SBU_SIZE", ("sbu", "size_category"), 5), Level("SBU", ("sbu",), 5), Level("GLOBAL", ()),
)
LIFECYCLE_CAP = 165.0
RESOLUTION_CAP = 300


def caps(df: DataFrame, value: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """p99 and p99.9 of a measure within limits."""
    x = F.col(value)
    df = df.filter(x.isNotNull())
    if low is not None:
        df = df.filter(x > low)
    if high is not None:
        df = df.filter(x <= high)
    return group_stats(df, [], [Stats(value, {"p99": 0.99, "p999": 0.999})], count="n_events")


def entity_counts(events: DataFrame, entity: str = "entity_id") -> DataFrame:
    return events.groupBy(entity).agg(F.count(F.lit(1)).alias("n_events"))


def count_profile(counts: DataFrame, levels: Sequence[Level] = COUNT_LEVELS) -> DataFrame:
    return profile_levels(counts, levels, [Stats("n_events", FOUR, ("max", "mean", "stddev"))], count="n_projects")


def trade_weights(events: DataFrame) -> DataFrame:
    """Percent of each trade within its SBU, and over all."""
    per = events.groupBy("sbu", "trade").agg(F.count(F.lit(1)).alias("n_events"))
    by_sbu = share_of_group(per, ["sbu"], "n_events", "pct_of_sbu").withColumn("level", F.lit("SBU"))
    total = per.groupBy("trade").agg(F.sum("n_events").alias("n_events"))
    overall = share_of_all(total, "n_events", "pct_of_sbu").withColumn("level", F.lit("GLOBAL"))
    return union_all([by_sbu, overall]).select("level", "sbu", "trade", "n_events", "pct_of_sbu")


def with_lifecycle(events: DataFrame, cap: float = LIFECYCLE_CAP) -> DataFrame:
    """Percent of the entity's span that has passed, from its start to the cap."""
    df = events.filter(F.col("created").isNotNull() & (F.col("created") >= F.col("dt_start")))
    df = df.withColumn("lifecycle_pct", clean.lifecycle_percent("created", "dt_start", "duration", 2))
    return df.filter(F.col("lifecycle_pct").between(0, cap))


def lifecycle_profile(lifecycle: DataFrame, min_rows: int = 5) -> DataFrame:
    return group_stats(lifecycle, ["trade"], [Stats("lifecycle_pct", FIVE, ("mean", "stddev"))], count="n_events", min_rows=min_rows)


def zone_shares(lifecycle: DataFrame) -> DataFrame:
    """Share of events below the trade's p20, above its p90, and between."""
    cuts = group_stats(lifecycle, ["trade"], [Stats("lifecycle_pct", {"lo": 0.20, "hi": 0.90})], count="n_all").drop("n_all")
    # events are counted per value first, so the join and the labels run on distinct values
    per_value = lifecycle.groupBy("trade", "lifecycle_pct").agg(F.count(F.lit(1)).alias("n"))
    zones = per_value.join(cuts, "trade").withColumn("zone", buckets.zone("lifecycle_pct", "lo", "hi"))
    per = zones.groupBy("trade", "zone").agg(F.sum("n").alias("n_events"))
    return share_of_group(per, ["trade"], "n_events", "pct_of_trade")


def resolution_profile(events: DataFrame, days: str, closed: Column, cap: int = RESOLUTION_CAP) -> DataFrame:
    df = events.filter(closed & F.col(days).between(1, cap))
    return group_stats(df, [], [Stats(days, FOUR, ("mean", "stddev"))], count="n_events")


def flag_rate(events: DataFrame, flag: Column, min_rows: int = 5) -> DataFrame:
    out = events.groupBy("trade").agg(F.count(F.lit(1)).alias("n_events"), F.count_if(flag).alias("__f"))
    return out.filter(F.col("n_events") >= min_rows).select(
        "trade", "n_events", F.round(F.col("__f") * 100.0 / F.col("n_events"), 4).alias("pct_flag")
    )


def status_distribution(events: DataFrame, status: str, closed: Sequence[str]) -> DataFrame:
    df = events.filter(F.trim(F.col(status)) != "").withColumn("status_simplified", clean.simple_status(status, closed))
    per = df.groupBy("sbu", "status_simplified").agg(F.count(F.lit(1)).alias("n_events"))
    return share_of_group(per, ["sbu"], "n_events", "pct")


def spike_ratios(
    event_days: DataFrame, anchor_days: DataFrame, entity: str = "entity_id", after: tuple[int, int] = (0, 30),
    before: tuple[int, int] = (-60, -31), keep: tuple[float, float] = (0.5, 5.0),
) -> DataFrame:
    """Events after an anchor over events before it. An anchor needs both windows filled;
    several anchors on one day count as often as they occur, by the weight `n_anchor`."""
    both = window_counts(event_days, anchor_days, entity, {"n_before": before, "n_after": after})
    both = both.filter((F.col("n_before") > 0) & (F.col("n_after") > 0))
    return both.withColumn("spike_ratio", F.col("n_after") / F.col("n_before")).filter(F.col("spike_ratio").between(*keep))


def spike_profile(ratios: DataFrame) -> DataFrame:
    """Quartiles, mean and deviation of the ratios, each counted `n_anchor` times. Equal ratios are added up before they are ordered."""
    counts = ratios.groupBy("spike_ratio").agg(F.sum("n_anchor").alias("__n")).withColumn("__all", one_key("spike_ratio"))
    run = ordered(counts, ["__all"], ["spike_ratio"], running_sum={"__cum": "__n"}, total={"n_events": "__n"})
    x, w = F.col("spike_ratio"), F.col("__n")
    quartiles = [F.min(F.when(F.col("__cum") >= F.ceil(F.col("n_events") * F.lit(p)), x)).alias(n) for n, p in percents("p25", "median", "p75").items()]
    out = run.agg(F.coalesce(F.max("n_events"), F.lit(0)).cast("long").alias("n_events"), *quartiles, F.sum(w * x).alias("__s"), F.sum(w * x * x).alias("__q"))
    n = F.col("n_events")
    deviation = F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("__q") - F.col("__s") * F.col("__s") / n) / (n - 1)))
    return out.select("n_events", "p25", "median", "p75", F.when(n > 0, F.col("__s") / n).alias("mean"), deviation.alias("stddev"))


def subcategory_frequency(events: DataFrame, codes: str, group: str = "trade", min_rows: int = 5, **rules) -> DataFrame:
    """Share of each usable code of an array column within its group."""
    df = events.select(group, F.explode(codes).alias("code")).withColumn("code", clean.label("code"))
    per = df.filter(clean.usable_code("code", **rules)).groupBy(group, "code").agg(F.count(F.lit(1)).alias("n_events"))
    return share_of_group(per, [group], "n_events", "pct_of_trade").filter(F.col("n_events") >= min_rows)


def example_pool(
    df: DataFrame, cell: Sequence[str], text: str, note: str, tie: str, k: int = 10, min_length: int = 50
) -> DataFrame:
    """The k longest distinct texts per cell, whole, as JSON with their note.

    Equal texts are found by hash and length; only the chosen rows' texts leave the scan. `tie` is unique.
    """
    df = df.filter(F.col(text).isNotNull() & (F.length(text) > min_length)).select(*cell, text, note, tie)
    short = df.select(*cell, tie, F.sha2(text, 256).alias("__hash"), F.length(text).alias("__len"))
    one = short.groupBy(*cell, "__hash", "__len").agg(F.min(tie).alias(tie))
    chosen = top_k(one, cell, [F.desc("__len"), F.col(tie)], k).select(*cell, "rank", tie)
    whole = chosen.join(df.select(tie, text, note), tie)
    return whole.select(
        *cell, "rank", tie, F.to_json(F.struct(F.col(text).alias("lesson"), F.col(note).alias("root_cause"))).alias("bounds_json")
    )


PROFILE_SCHEMA = {
    "level": "string", "field": "string", "sbu": "string", "size_category": "string", "trade": "string", "code": "string",
    "status_simplified": "string", "n_projects": "long", "n_events": "long", "max": "long", "p10": "double", "p25": "double",
    "median": "double", "p75": "double", "p90": "double", "mean": "double", "stddev": "double", "pct_of_sbu": "double",
    "pct_of_trade": "double", "pct_flag": "double", "pct": "double",
}
CONSTRAINT_SCHEMA = {
    "level": "string", "field": "string", "sbu": "string", "size_category": "string", "trade": "string",
    "n_projects": "long", "n_events": "long", "bounds_json": "string",
}


def profile_table(parts: dict[tuple[str, str | None], DataFrame]) -> DataFrame:
    """(field, level or None when the part has one) -> profile, in one schema."""
    out = []
    for (name, level), df in parts.items():
        df = df.withColumn("field", F.lit(name))
        if level:
            df = df.withColumn("level", F.lit(level))
        if "zone" in df.columns:
            df = df.withColumnRenamed("zone", "status_simplified")
        out.append(clean.pad(df, PROFILE_SCHEMA))
    return union_all(out)


def constraint_table(parts: dict[tuple[str, str | None], tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    out = []
    for (name, level), (df, cols) in parts.items():
        df = df.withColumn("field", F.lit(name))
        if level:
            df = df.withColumn("level", F.lit(level))
        if cols:
            df = df.withColumn("bounds_json", bounds_json(list(cols)))
        out.append(clean.pad(df, CONSTRAINT_SCHEMA))
    return union_all(out)
