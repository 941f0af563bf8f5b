"""Group statistics and quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions.clean import col
from sigloom.operators.ordered import one_key, ordered

ACCURACY = 50_000  # exact for groups up to about half as many rows; beyond, the rank is off by at most 1/ACCURACY

PERCENTS = {
    "p1": 0.01, "p5": 0.05, "p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90,
    "p95": 0.95, "p99": 0.99,
}


def percents(*names: str) -> dict[str, float]:
    return {n: PERCENTS[n] for n in names}


def approx(x, p: float, accuracy: int = ACCURACY) -> Column:
    return F.percentile_approx(col(x), p, accuracy)


@dataclass(frozen=True)
class Stats:
    """Statistics of one measure. All quantiles share one sketch; `aggs` then `columns`."""

    value: str
    quantiles: Mapping[str, float] = field(default_factory=dict)
    basics: Sequence[str] = ()  # min max mean stddev
    names: Mapping[str, str] = field(default_factory=dict)  # renames of the basics
    prefix: str = ""
    suffix: str = ""
    accuracy: int = ACCURACY

    def _q(self) -> str:
        return f"__q_{self.prefix}{self.value}{self.suffix}"

    def aggs(self) -> list[Column]:
        makers = {"min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev_samp, "n_nonnull": F.count}
        out = [makers[b](self.value).alias(self._name(b)) for b in self.basics]
        if self.quantiles:
            ps = F.array(*[F.lit(float(p)) for p in self.quantiles.values()])
            out.append(F.percentile_approx(self.value, ps, self.accuracy).alias(self._q()))
        return out

    def _name(self, stat: str) -> str:
        return f"{self.prefix}{self.names.get(stat, stat)}{self.suffix}"

    def columns(self) -> dict[str, Column]:
        """Output name -> column over the aggregated row."""
        out = {
            f"{self.prefix}{n}{self.suffix}": F.col(f"`{self._q()}`")[i] for i, n in enumerate(self.quantiles)
        }
        return out | {self._name(b): F.col(f"`{self._name(b)}`") for b in self.basics}


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Stats],
    *,
    count: str = "n",
    extra: Mapping[str, Column] | None = None,
    min_rows: int = 0,
    min_on: str | None = None,
) -> DataFrame:
    """One aggregate per group; `min_rows` is the HAVING on the count (or on another column)."""
    extra = dict(extra or {})
    aggs = [F.count(F.lit(1)).alias(count), *[e.alias(n) for n, e in extra.items()]]
    for s in stats:
        aggs += s.aggs()
    out = (df.groupBy(*keys) if keys else df.groupBy()).agg(*aggs)
    if min_rows:
        out = out.filter(F.col(min_on or count) >= min_rows)
    cols = [c.alias(n) for s in stats for n, c in s.columns().items()]
    return out.select(*keys, count, *extra, *cols)


def first_of(keys: Sequence[str], value: str) -> Column:
    """True in one row of each distinct value of a group, so that `count_if` counts the values.

    Beside a sketch a distinct aggregate would keep one sketch for each value of each group.
    """
    return F.col(value).isNotNull() & (F.row_number().over(W.partitionBy(*keys, value).orderBy(value)) == 1)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """Rows per distinct value. A hot group is spread over tasks by its values."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    *,
    min_rows: int = 1,
    count: str = "n",
    digits: int | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles from running counts over distinct values.

    No group is held in memory: counts come pre-aggregated, the running sum is sliced for hot
    groups and the final pick is a conditional minimum. Infinities are dropped; groups with
    fewer than `min_rows` values get NULL quantiles.
    """
    counts = finite_counts(df, keys, value)
    return quantiles_of_counts(counts, keys, quantiles, min_rows=min_rows, count=count, digits=digits, rows_per_slice=rows_per_slice)


def finite_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows (*keys, `__v`, `__n`): how often a group holds each finite value."""
    finite = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(
        F.col("__v").isNotNull() & ~F.isnan("__v") & (F.abs("__v") != float("inf"))
    )
    return value_counts(finite, keys, "__v", "__n")


def quantiles_of_counts(
    counts: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float], *, min_rows: int = 1, count: str = "n", digits: int | None = None, rows_per_slice: int | None = None
) -> DataFrame:
    """`exact_quantiles` of the groups' `finite_counts`. A value may come in several rows, whose counts then add up."""
    names = list(keys)
    if not names:
        counts = counts.withColumn("__all", one_key("__v"))
    parts = names or ["__all"]
    kw = {"rows_per_slice": rows_per_slice} if rows_per_slice else {}
    run = ordered(counts, parts, ["__v"], running_sum={"__cum": "__n"}, total={"__total": "__n"}, **kw)
    aggs = [F.max("__total").alias(count)]
    for n, p in quantiles.items():
        h = (F.col("__total") - 1) * F.lit(float(p))
        aggs.append(F.min(F.when(F.col("__cum") > F.floor(h), F.col("__v"))).alias(f"__lo_{n}"))
        aggs.append(F.min(F.when(F.col("__cum") > F.ceil(h), F.col("__v"))).alias(f"__hi_{n}"))
    out = run.groupBy(*parts).agg(*aggs)
    cols = []
    for n, p in quantiles.items():
        h = (F.col(count) - 1) * F.lit(float(p))
        q = F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * (h - F.floor(h))
        q = F.when(F.col(count) >= min_rows, q)
        cols.append((F.round(q, digits) if digits is not None else q).alias(n))
    return out.select(*names, count, *cols)
