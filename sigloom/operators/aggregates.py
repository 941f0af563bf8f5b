"""Aggregations with their own rules: presence, mixes, modes, quotas, bounds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.operators.ordered import ordered


def flag_if_any(cond: Column) -> Column:
    return F.max(F.when(cond, 1).otherwise(0))


def first_by(names: Sequence[str], order: Sequence[str]) -> Column:
    """The named columns of the earliest row, as one struct: deterministic, unlike `first`."""
    return F.min_by(F.struct(*names), F.struct(*order))


def latest_rows(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows at the latest date of their group, ties kept. One row per group is joined back."""
    last = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(last, [*keys, date], "left_semi")


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one lowest in `order`."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def best_duplicate(df: DataFrame, keys: Sequence[str], score: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per key, the one with the highest score."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(score, *tie)).alias("__r"))
        .select(*[F.col(c) if c in keys else F.col(f"__r.{c}") for c in df.columns])
    )


def presence(
    df: DataFrame, entities: DataFrame, entity: str, item: str, group: str | None = None, mandatory: Sequence[str] = ()
) -> DataFrame:
    """Share of a group's entities (all of them, not only those with rows) that have the item."""
    by = [group] if group else []
    having = df.groupBy(*by, item).agg(F.count_distinct(entity).alias("n_with"))
    if group:
        totals = entities.groupBy(group).agg(F.count_distinct(entity).alias("n_total"))
        out = having.join(totals, group)
    else:
        out = having.withColumn("n_total", entities.agg(F.count_distinct(entity)).scalar())
    return out.withColumns(
        {
            "presence_prob": F.round(F.col("n_with") / F.col("n_total"), 4),
            "is_mandatory": F.col(item).isin(*mandatory) if mandatory else F.lit(False),
        }
    )


def frequency(df: DataFrame, keys: Sequence[str], item: str, entity: str, n: str = "n_entities") -> DataFrame:
    """Entities per item of a group, one row per item."""
    return df.groupBy(*keys, item).agg(F.count_distinct(entity).alias(n))


def frequency_json(freq: DataFrame, keys: Sequence[str], item: str, n: str, chunk: int = 1000) -> DataFrame:
    """Frequency lists as JSON, most frequent first, in chunks of bounded length.

    A group's list is cut into rows of `chunk` entries, so no group has to fit in one task.
    """
    ranked = ordered(
        freq.withColumn("__desc", -F.col(n)), list(keys), ["__desc", item], row_number="rank"
    ).withColumn("part", F.floor((F.col("rank") - 1) / chunk).cast("int"))
    entry = F.struct("rank", F.col(item).alias("item"), F.col(n).alias("n"))
    packed = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e["item"].alias("item"), e["n"].alias("n")))
    return ranked.groupBy(*keys, "part").agg(F.to_json(packed).alias("json_blob"), F.max(n).alias("n_max"))


def collapsed_mix(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    amount: str,
    entity: str,
    min_weight: float = 0.05,
    min_entities: int = 5,
    other: str = "other",
) -> DataFrame:
    """Amount-weighted mix. Categories below either limit give their weight to the kept ones
    in proportion; a group that keeps none is all `other`."""
    cells = df.groupBy(*keys, category).agg(F.sum(amount).alias("__amt"), F.count_distinct(entity).alias("n_entities"))
    g = W.partitionBy(*keys)  # one row per category: a vocabulary, not data
    cells = cells.withColumn("__w", F.col("__amt") / F.sum("__amt").over(g))
    cells = cells.withColumn("__kept", (F.col("__w") >= min_weight) & (F.col("n_entities") >= min_entities))
    kept_w = F.when(F.col("__kept"), F.col("__w"))
    cells = cells.withColumns({"__sum_kept": F.sum(kept_w).over(g), "__sum_all": F.sum("__w").over(g)})
    weight = F.col("__w") + (F.col("__sum_all") - F.col("__sum_kept")) * F.col("__w") / F.col("__sum_kept")
    named = cells.filter("__kept").select(*keys, category, F.round(weight / F.col("__sum_all"), 4).alias("weight"))
    empty = cells.filter(F.col("__sum_kept").isNull()).select(*keys).distinct()
    return named.unionByName(empty.select(*keys, F.lit(other).alias(category), F.lit(1.0).alias("weight")))


def mode_by_group(df: DataFrame, key: str, x: str) -> DataFrame:
    """Most frequent value per group (smallest on ties), the global mode where a group has none."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(key, x).agg(F.count(F.lit(1)).alias("__n"))

    def top(d: DataFrame, keys: list[str]) -> DataFrame:
        return d.groupBy(*keys).agg(F.min_by(x, F.struct(-F.col("__n"), F.col(x))).alias("mode"))

    overall = top(counts.groupBy(x).agg(F.sum("__n").alias("__n")), []).scalar()
    return (
        df.select(key).distinct().join(top(counts, [key]), key, "left")
        .select(key, F.coalesce(F.col("mode"), overall).alias("mode"))
    )


def pmf(df: DataFrame, keys: Sequence[str], x: str, digits: int = 6) -> DataFrame:
    """Relative frequency of each value within its group."""
    counts = df.filter(F.col(x).isNotNull()).groupBy(*keys, x).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("__t"))
    return (
        counts.join(total, list(keys)).select(*keys, x, "n", F.round(F.col("n") / F.col("__t"), digits).alias("prob"))
    )


def quotas(df: DataFrame, group: str, total: int, too_small: int = 5) -> DataFrame:
    """Rows to generate per group, in proportion; the rounding difference and the quota of tiny
    groups go to the largest group. Works on one row per group."""
    sizes = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n_real"))
    every = sizes.agg(F.sum("n_real")).scalar()
    share = sizes.withColumns(
        {"quota": F.round(F.col("n_real") / every * total, 0).cast("int"), "is_tiny": F.col("n_real") < too_small}
    )
    largest = sizes.agg(F.min_by(F.col(group), F.struct(-F.col("n_real"), F.col(group)))).scalar()
    given = share.agg(F.sum("quota")).scalar()
    carried = share.agg(F.coalesce(F.sum(F.when(F.col("is_tiny"), F.col("quota"))), F.lit(0))).scalar()
    return share.select(
        group,
        "n_real",
        F.when(F.col(group) == largest, F.col("quota") + (F.lit(total) - given) + carried)
        .when(F.col("is_tiny"), 0)
        .otherwise(F.col("quota"))
        .cast("int")
        .alias("quota"),
    )


def bounds_json(names: Mapping[str, str] | Sequence[str]) -> Column:
    """JSON map of the named columns as doubles; NULL values stay in the map."""
    items = names.items() if isinstance(names, Mapping) else [(n, n) for n in names]
    return F.to_json(F.create_map(*[x for k, c in items for x in (F.lit(k), F.col(c).cast("double"))]))


def pivot_shares(df: DataFrame, key: str, category: str, values: Sequence[str], prefix: str = "pct_", digits: int = 2) -> DataFrame:
    """Percent of each listed category per key, over all categories."""
    total = F.count(F.lit(1))
    return df.groupBy(key).agg(
        *[
            F.when(F.count_if(F.col(category) == v) > 0, F.round(F.count_if(F.col(category) == v) * 100.0 / total, digits)).alias(f"{prefix}{v}")
            for v in values
        ]
    )
