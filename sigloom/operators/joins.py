"""Joins that the reference semantics need beyond a plain equi-join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_large_groups(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Rows of groups that have at least `min_rows` rows; NULL keys never match."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_rows)
    return df.join(big.select(*keys), list(keys), "left_semi")


def totals_with_stats(totals: DataFrame, stats: DataFrame, keys: Sequence[str], zero: Sequence[str]) -> DataFrame:
    """Left join; the named counts become 0 where no statistics exist."""
    out = totals.join(stats, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Keys of the child without a parent, with their row counts.

    The child is counted per key first, so a hot key is one row by the time it is joined.
    """
    per_key = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(parent_key or child_key).alias(child_key)).distinct()
    return per_key.join(keys, child_key, "left_anti")


def reconcile_counts(a: DataFrame, b: DataFrame, key: str, na: str = "n_a", nb: str = "n_b") -> DataFrame:
    """Full outer comparison of two per-key count tables."""
    out = a.join(b, key, "full_outer")
    out = out.withColumns({na: F.coalesce(F.col(na), F.lit(0)), nb: F.coalesce(F.col(nb), F.lit(0))})
    return out.withColumn("is_match", F.col(na) == F.col(nb))


def share_of_group(counts: DataFrame, group: Sequence[str], n: str, out: str, digits: int = 4) -> DataFrame:
    """Percent of the group's total. Runs on aggregated counts."""
    total = F.sum(n).over(W.partitionBy(*group))
    return counts.withColumn(out, F.round(F.col(n) * 100.0 / total, digits))


def share_of_all(counts: DataFrame, n: str, out: str, digits: int = 4) -> DataFrame:
    """Percent of the grand total, which is a scalar subquery: no single-partition window."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(out, F.round(F.col(n) * 100.0 / total, digits))


def daily_counts(df: DataFrame, entity: str, day: Column, n: str = "n") -> DataFrame:
    """Rows per (entity, day): bounds what one entity can bring to a later window."""
    return df.select(entity, day.alias("day")).filter(F.col("day").isNotNull()).groupBy(entity, "day").agg(
        F.count(F.lit(1)).alias(n)
    )


def window_counts(
    events: DataFrame, anchors: DataFrame, entity: str, windows: Mapping[str, tuple[int, int]], weight: str = "n_anchor"
) -> DataFrame:
    """Events of the anchor's entity in [day + lo, day + hi], per (entity, anchor day) and window.

    Both sides come as (entity, day, count). Instead of pairing events with anchors, the two
    day tables are stacked and each window is a RANGE frame over days.
    """
    both = events.select(entity, "day", F.col("n").alias("__e"), F.lit(None).cast("long").alias(weight)).unionByName(
        anchors.select(entity, "day", F.lit(None).cast("long").alias("__e"), F.col("n").alias(weight))
    )
    both = both.groupBy(entity, "day").agg(F.sum("__e").alias("__e"), F.sum(weight).alias(weight))
    w = W.partitionBy(entity).orderBy("__d")
    out = both.withColumn("__d", F.unix_date("day"))
    out = out.withColumns(
        {name: F.coalesce(F.sum("__e").over(w.rangeBetween(lo, hi)), F.lit(0)) for name, (lo, hi) in windows.items()}
    )
    return out.filter(F.col(weight).isNotNull()).select(entity, "day", weight, *windows)


def near_anchor(days: DataFrame, anchors: DataFrame, entity: str, lo: int, hi: int) -> DataFrame:
    """(entity, day, is_near): an anchor lies within [lo, hi] days before the day."""
    both = days.select(entity, "day", F.lit(1).alias("__want"), F.lit(0).alias("__a")).unionByName(
        anchors.select(entity, "day", F.lit(0).alias("__want"), F.lit(1).alias("__a"))
    )
    both = both.groupBy(entity, "day").agg(F.max("__want").alias("__want"), F.max("__a").alias("__a"))
    w = W.partitionBy(entity).orderBy(F.unix_date("day")).rangeBetween(-hi, -lo)
    return (
        both.withColumn("is_near", F.coalesce(F.max("__a").over(w), F.lit(0)) == 1)
        .filter(F.col("__want") == 1)
        .select(entity, "day", "is_near")
    )


def nearest_distance(days: DataFrame, anchors: DataFrame, entity: str, out: str = "min_days") -> DataFrame:
    """(entity, day, distance in days to the closest anchor, NULL without one), as-of both ways."""
    both = days.select(entity, "day", F.lit(1).alias("__want"), F.lit(None).cast("date").alias("__a")).unionByName(
        anchors.select(entity, "day", F.lit(0).alias("__want"), F.col("day").alias("__a"))
    )
    both = both.groupBy(entity, "day").agg(F.max("__want").alias("__want"), F.max("__a").alias("__a"))
    upto = (W.unboundedPreceding, W.currentRow)
    back = F.last("__a", ignorenulls=True).over(W.partitionBy(entity).orderBy("day").rowsBetween(*upto))
    ahead = F.last("__a", ignorenulls=True).over(W.partitionBy(entity).orderBy(F.desc("day")).rowsBetween(*upto))
    dist = F.least(F.datediff("day", back), F.datediff(ahead, "day"))
    return both.withColumn(out, dist).filter(F.col("__want") == 1).select(entity, "day", out)


def active_on_spine(
    intervals: DataFrame, entity: str, start: str, end: str, *, step_days: int = 7, keep: Sequence[str] = (), out: str = "n_active"
) -> DataFrame:
    """Intervals open on each day of a spine from the entity's first start to its last end.

    Sweep line: +1 where an interval reaches its first spine day, -1 after its last; the running
    sum over spine steps is the number of open intervals. No interval meets a spine row in a join.
    """
    span = intervals.groupBy(entity, *keep).agg(F.min(start).alias("__s"), F.max(end).alias("__e"))
    steps = span.select(
        entity, *keep, "__s",
        F.explode(F.sequence(F.lit(0), F.floor(F.datediff("__e", "__s") / step_days).cast("int"))).alias("__k"),
    )
    first = F.ceil(F.datediff(start, "__s") / step_days).cast("int")
    after = (F.floor(F.datediff(end, "__s") / step_days) + 1).cast("int")
    marks = (
        intervals.select(entity, start, end)
        .join(span.select(entity, "__s"), entity)
        .select(entity, F.explode(F.array(F.struct(first.alias("k"), F.lit(1).alias("d")), F.struct(after.alias("k"), F.lit(-1).alias("d")))).alias("m"))
        .select(entity, F.col("m.k").alias("__k"), F.col("m.d").alias("__d"))
        .groupBy(entity, "__k").agg(F.sum("__d").alias("__d"))
    )
    w = W.partitionBy(entity).orderBy("__k").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        steps.join(marks, [entity, "__k"], "left")
        .withColumn(out, F.sum(F.coalesce(F.col("__d"), F.lit(0))).over(w))
        .select(entity, *keep, F.date_add("__s", F.col("__k") * step_days).alias("spine_day"), out)
    )


def coverage(base: DataFrame, key: str, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Which tables hold each key; an absent table is false everywhere."""
    out = base.select(key).distinct()
    for name, df in tables.items():
        if df is None:
            out = out.withColumn(f"has_{name}", F.lit(False))
            continue
        seen = df.select(key).distinct().withColumn(f"has_{name}", F.lit(True))
        out = out.join(seen, key, "left").withColumn(f"has_{name}", F.coalesce(F.col(f"has_{name}"), F.lit(False)))
    return out


def map_to_codes(df: DataFrame, category: str, mapping: Mapping[str, Sequence[str]], out: str = "code") -> DataFrame:
    """One row per listed code of the row's category; unlisted categories drop out."""
    table = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))])
    return df.withColumn(out, F.explode(F.try_element_at(table, F.col(category))))
