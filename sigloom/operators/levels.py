"""One aggregate over a hierarchy of group levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.operators.quantiles import Stats, finite_counts, quantiles_of_counts


@dataclass(frozen=True)
class Level:
    """A named key set. `min_rows` is its HAVING; `non_null` keys must be present."""

    name: str
    keys: tuple[str, ...]
    min_rows: int = 0
    non_null: tuple[str, ...] = ()


def level_keys(levels: Sequence[Level]) -> list[str]:
    seen: list[str] = []
    for lv in levels:
        seen += [k for k in lv.keys if k not in seen]
    return seen


def profile_levels(
    df: DataFrame,
    levels: Sequence[Level],
    stats: Sequence[Stats] = (),
    *,
    common: Sequence[str] = (),
    count: str = "n",
    extra: Mapping[str, Column] | None = None,
    min_on: str | None = None,
) -> DataFrame:
    """GROUPING SETS over all levels: `level`, keys (NULL where unused), count, statistics.

    The level is read from grouping_id, so a real NULL key is never mistaken for a total row.
    """
    extra = dict(extra or {})
    keys = list(common) + level_keys(levels)
    gid_of = {}
    for lv in levels:
        used = set(common) | set(lv.keys)
        gid = sum(0 if k in used else 1 << (len(keys) - 1 - i) for i, k in enumerate(keys))
        if gid in gid_of:
            raise ValueError(f"levels {gid_of[gid].name} and {lv.name} have the same keys")
        gid_of[gid] = lv
    aggs = [F.count(F.lit(1)).alias(count), *[e.alias(n) for n, e in extra.items()]]
    for s in stats:
        aggs += s.aggs()
    sets = [[*common, *lv.keys] for lv in levels]
    out = df.groupingSets(sets, *keys).agg(F.grouping_id().cast("int").alias("__gid"), *aggs)
    name, keep = None, None
    for gid, lv in gid_of.items():
        here = F.col("__gid") == gid
        name = F.when(here, lv.name) if name is None else name.when(here, lv.name)
        ok = here
        if lv.min_rows:
            ok = ok & (F.col(min_on or count) >= lv.min_rows)
        for k in lv.non_null:
            ok = ok & F.col(k).isNotNull()
        keep = ok if keep is None else keep | ok
    cols = [c.alias(n) for s in stats for n, c in s.columns().items()]
    return out.filter(keep).select(name.alias("level"), *keys, count, *extra, *cols)


def profile_fields(
    df: DataFrame,
    levels: Sequence[Level],
    fields: Sequence[str],
    quantiles: Mapping[str, float],
    basics: Sequence[str],
    *,
    count: str = "n_total",
) -> DataFrame:
    """Statistics of several fields: one row per level, group and field.

    The fields are aggregated side by side and the few result rows are turned into long form;
    unpivoting the input first would multiply its rows by the number of fields.
    """
    wide = df.select(*level_keys(levels), *[F.col(f).cast("double").alias(f) for f in fields])
    stats = [Stats(f, quantiles, ("n_nonnull", *basics), prefix=f"{f}::") for f in fields]
    out = profile_levels(wide, levels, stats, count=count)
    names = ("n_nonnull", *quantiles, *basics)
    rows = [F.struct(F.lit(f).alias("field"), *[F.col(f"`{f}::{n}`").alias(n) for n in names]) for f in fields]
    return out.select("level", *level_keys(levels), count, F.inline(F.array(*rows)))


def unpivot_fields(df: DataFrame, keep: Sequence[str], fields: Sequence[str], value: str = "value") -> DataFrame:
    """One row per (row, field), values as double."""
    doubles = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in fields])
    return doubles.unpivot(list(keep), list(fields), "field", value)


def stack_levels(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """One copy of each row per level, with `level` and NULL in the keys the level does not use.

    For aggregates that GROUPING SETS cannot carry; run it on already aggregated rows.
    """
    keys = level_keys(levels)
    types = dict(df.dtypes)
    copies = []
    for lv in levels:
        ok = F.lit(True)
        for k in lv.non_null:
            ok = ok & F.col(k).isNotNull()
        parts = [F.lit(lv.name).alias("level")]
        parts += [(F.col(k) if k in lv.keys else F.lit(None).cast(types[k])).alias(k) for k in keys]
        copies.append(F.when(ok, F.struct(*parts)))
    rest = [c for c in df.columns if c not in keys]
    out = df.select(*rest, F.explode(F.array_compact(F.array(*copies))).alias("__lv"))
    return out.select(*rest, "__lv.*")


def exact_profile_levels(
    df: DataFrame, levels: Sequence[Level], value: str, quantiles: Mapping[str, float], *, common: Sequence[str] = (), min_values: int = 3, count: str = "n", digits: int | None = None
) -> DataFrame:
    """Interpolated quantiles per level; `Level.min_rows` is the HAVING on rows with a value.

    Values are counted once, by the keys of all levels; the levels are copies of these counts.
    """
    keys = [*common, "level", *level_keys(levels)]
    stacked = stack_levels(finite_counts(df, [*common, *level_keys(levels)], value), levels)
    out = quantiles_of_counts(stacked, keys, quantiles, min_rows=min_values, count=count, digits=digits)
    keep = F.lit(False)
    for lv in levels:
        keep = keep | ((F.col("level") == lv.name) & (F.col(count) >= lv.min_rows))
    return out.filter(keep)


def counted_levels(
    df: DataFrame, levels: Sequence[Level], stats: Stats, *, common: Sequence[str] = (), count: str = "n", mean: tuple[str, int] | None = None
) -> DataFrame:
    """`profile_levels` for one measure with few distinct values, without a sketch for each group and task: rows are counted per value
    once, and all levels are read from these counts. A quantile is the value at rank ceil(p * n). `mean` names a rounded mean."""
    keys, value = level_keys(levels), stats.value
    counts = df.groupBy(*common, *keys, value).agg(F.count(F.lit(1)).alias("__n"))
    per = stack_levels(counts, levels).groupBy(*common, "level", *keys, value).agg(F.sum("__n").alias("__n"))
    held = F.when(F.col(value).isNotNull(), F.col("__n"))
    whole = W.partitionBy(*common, "level", *keys)
    upto = whole.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = per.withColumns({"__upto": F.sum(held).over(upto), "__of": F.sum(held).over(whole)})
    avg = F.sum(F.col(value) * F.col("__n")) / F.sum(held)
    makers = {"min": F.min(value), "max": F.max(value), "mean": avg}
    aggs = {count: F.sum("__n")} | ({mean[0]: F.round(avg, mean[1])} if mean else {})
    for n, p in stats.quantiles.items():
        aggs[f"{stats.prefix}{n}{stats.suffix}"] = F.min(F.when(F.col("__upto") >= F.ceil(F.lit(float(p)) * F.col("__of")), F.col(value)))
    aggs |= {stats._name(b): makers[b] for b in stats.basics}
    out = run.groupBy(*common, "level", *keys).agg(*[a.alias(n) for n, a in aggs.items()])
    keep = F.lit(False)
    for lv in levels:
        keep = keep | ((F.col("level") == lv.name) & (F.col(count) >= lv.min_rows))
    return out.filter(keep).select("level", *common, *keys, *aggs)
