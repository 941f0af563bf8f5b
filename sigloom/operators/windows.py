"""Ordered-chain operators of versioned and sequential tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions.values import OPEN_END
from sigloom.operators.ordered import PLAIN_BYTES, bytes_below, ordered, written


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "seq", **kw) -> DataFrame:
    return ordered(df, keys, order, row_number=out, **kw)


def countdown(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n_recent", active: str = "is_active", **kw) -> DataFrame:
    """n, n-1, ... 1 along the order; the last row is the active one."""
    got = ordered(df, keys, order, row_number="__i", count="__n", **kw)
    left = (F.col("__n") - F.col("__i") + 1).cast("int")
    return got.withColumns({out: left, active: left == 1}).drop("__i", "__n")


def delays(df: DataFrame, keys: Sequence[str], order: Sequence[str], date: str, *, positive_only: bool = True, out: str = "delay_days", **kw) -> DataFrame:
    """Days by which a date moved since the previous row."""
    got = ordered(df, keys, order, lag={f"prev_{date}": date}, **kw)
    got = got.withColumn(out, F.datediff(date, f"prev_{date}")).filter(F.col(out).isNotNull())
    return got.filter(F.col(out) > 0) if positive_only else got


def changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, **kw) -> DataFrame:
    """Rows whose value differs from the previous row's."""
    got = ordered(df, keys, order, lag={f"prev_{x}": x}, **kw)
    return got.filter(F.col(f"prev_{x}").isNotNull() & (F.col(x) != F.col(f"prev_{x}")))


def regressions(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, eps: float = 0.0, **kw) -> DataFrame:
    """Rows that fall below the previous row by more than eps."""
    got = ordered(df, keys, order, lag={f"prev_{x}": x}, **kw)
    limit = F.col(f"prev_{x}") - eps if eps else F.col(f"prev_{x}")
    return got.filter(F.col(f"prev_{x}").isNotNull() & (F.col(x) < limit))


def overlaps(df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str] = (), **kw) -> DataFrame:
    """Rows that end after the next row starts; touching dates pass."""
    got = ordered(df, keys, [start, *tie], lead={"next_start": start}, **kw)
    return got.filter(F.col("next_start").isNotNull() & (F.col(end) > F.col("next_start")))


def ratio_to_next(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, low: float, high: float, min_base: float, digits: int = 3, **kw) -> DataFrame:
    """Next value over this one, for bases of at least `min_base`, kept within [low, high]."""
    got = ordered(df, keys, order, lead={f"next_{x}": x}, **kw)
    got = got.filter(F.col(f"next_{x}").isNotNull() & (F.col(x) >= min_base))
    return got.withColumn("ratio", F.round(F.col(f"next_{x}") / F.col(x).cast("double"), digits)).filter(
        F.col("ratio").between(low, high)
    )


def monotone(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, out: str = "monotone", **kw) -> DataFrame:
    """Running maximum of the value clipped to [0, 1]."""
    clipped = df.withColumn("__x", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(x))))
    return ordered(clipped, keys, order, running_max={out: "__x"}, **kw).drop("__x")


def top_k(df: DataFrame, keys: Sequence[str], order, k: int, out: str = "rank") -> DataFrame:
    """First k rows per group. The limit is applied in the map tasks before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(out, rank).filter(F.col(out) <= k)


def closing_dates(df: DataFrame, keys: Sequence[str], start: str, out: str = "effective_to", tie: Sequence[str] = (), open_end: str = OPEN_END, **kw) -> DataFrame:
    """The day before the next start, never before the own start; the last row stays open."""
    got = ordered(df, keys, [start, *tie], lead={"__next": start}, **kw)
    close = F.greatest(F.col(start), F.date_sub("__next", 1))
    return got.withColumn(out, F.when(F.col("__next").isNull(), F.lit(open_end).cast("date")).otherwise(close)).drop("__next")


def spaced(df: DataFrame, keys: Sequence[str], order: Sequence[str], t: str, gap: float, cap: float, out: str = "spaced", **kw) -> DataFrame:
    """Sorted times pushed at least `gap` apart from zero on and capped.

    Closed form of t_i = min(cap, max(t_i, t_{i-1} + gap)): a running maximum of t - i*gap.
    """
    got = ordered(df, keys, order, row_number="__i", **kw).withColumn("__y", F.col(t) - F.col("__i") * F.lit(gap))
    got = ordered(got, keys, order, running_max={"__m": "__y"}, **kw)
    i = F.col("__i") * F.lit(gap)
    return got.withColumn(out, F.least(F.lit(cap), F.greatest(i, i + F.col("__m")))).drop("__i", "__y", "__m")


def shifted(df: DataFrame, keys: Sequence[str], order: Sequence[str], base: str, days: str, out: str = "shifted", **kw) -> DataFrame:
    """Base date plus the running sum of days."""
    got = ordered(df, keys, order, running_sum={"__s": days}, **kw)
    return got.withColumn(out, F.date_add(base, F.col("__s").cast("int"))).drop("__s")


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, x: str, periods: int = 3, out: str = "rate3") -> DataFrame:
    """Mean of the last periods, for tables with one row per entity and period."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(-(periods - 1), 0)
    return df.withColumn(out, F.avg(x).over(w))


def periods_since(df: DataFrame, keys: Sequence[str], period: str, flag: str, out: str = "since") -> DataFrame:
    """0 in the period of an event, then counting up; NULL before the first."""
    w = W.partitionBy(*keys).orderBy(period).rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.last(F.when(F.col(flag), F.col(period)), ignorenulls=True).over(w)
    return df.withColumn(out, F.col(period) - last)


def thirds(df: DataFrame, keys: Sequence[str], order: Sequence[str], labels: Sequence[str] = ("early", "mid", "late"), out: str = "phase", **kw) -> DataFrame:
    """First and last floor(n/3) rows, and the middle with any remainder."""
    got = ordered(df, keys, order, row_number="__i", count="__n", **kw)
    third = F.floor(F.col("__n") / 3)
    phase = F.when(F.col("__i") <= third, labels[0]).when(F.col("__i") > F.col("__n") - third, labels[2]).otherwise(labels[1])
    return got.withColumn(out, phase).drop("__i", "__n")


#: rows of a key up to which its pairs are counted inside one row
FEW_ROWS = 64


def inversions(df: DataFrame, key: str, order: str, x: str, *, few_rows: int = FEW_ROWS, **kw) -> DataFrame:
    """(key, n_rows, n_pairs, n_inversions): pairs in order whose values go down.

    Keys of up to `few_rows` rows are counted pair by pair inside one row. The others are counted bit by bit: two values
    compare by their highest differing bit, so within rows that share the bits above b, every 1 at bit b that stands before a 0
    is one inversion. That is rows x bits work; the bits are dealt by (key, bit), so that a task's share follows from them and not from the rows,
    and the running counts are sliced for hot keys.
    `order` and `x` must be whole numbers or dates, the range of `x` in a key below 2 ** 63; rows with equal
    order make no pair.
    """
    def number(name: str):
        return F.unix_date(name).cast("long") if dict(df.dtypes)[name] == "date" else F.col(name).cast("long")

    base = df.select(key, number(order).alias("__o"), number(x).alias("__x")).dropna()
    if bytes_below(df) > PLAIN_BYTES:
        base = written(base)  # read for the sizes of the keys, the small and the large ones
    lows = base.groupBy(key).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"), F.count(F.lit(1)).alias("n_rows"))
    few = _few_inversions(base.join(lows.filter(F.col("n_rows") <= few_rows).select(key), key, "left_semi"), key)
    return few.unionByName(_many_inversions(base, lows.filter(F.col("n_rows") > few_rows), key, **kw))


def _few_inversions(base: DataFrame, key: str) -> DataFrame:
    rows = base.groupBy(key).agg(F.collect_list(F.struct("__o", "__x")).alias("__r"))

    def pairs(goes_down: bool) -> Column:
        def after(a: Column) -> Column:
            return F.size(F.filter("__r", lambda b: (b["__o"] > a["__o"]) & (b["__x"] < a["__x"]) if goes_down else b["__o"] > a["__o"]))

        return F.aggregate("__r", F.lit(0).cast("long"), lambda n, a: n + after(a))

    return rows.select(key, F.size("__r").cast("long").alias("n_rows"), pairs(False).alias("n_pairs"), pairs(True).alias("n_inversions"))


def _many_inversions(base: DataFrame, lows: DataFrame, key: str, **kw) -> DataFrame:
    base = base.join(lows.select(key, "__lo", "__hi"), key)
    bits = F.length(F.bin(F.col("__hi") - F.col("__lo")))
    v = F.col("__x") - F.col("__lo")
    exploded = base.filter(F.col("__hi") > F.col("__lo")).select(
        key, "__o", v.alias("__v"), F.explode(F.sequence(F.lit(0), F.greatest(bits - 1, F.lit(0)))).alias("__b")
    )
    cells = (
        exploded.select(
            key, "__b", "__o",
            F.expr("shiftright(__v, __b + 1)").alias("__p"),
            F.expr("shiftright(__v, __b) & 1").alias("__bit"),
        )
        .repartition(key, "__b")
        .groupBy(key, "__b", "__p", "__o")
        .agg(F.sum("__bit").alias("__ones"), F.sum(1 - F.col("__bit")).alias("__zeros"))
    )
    run = ordered(cells, [key, "__b", "__p"], ["__o"], running_sum={"__upto": "__ones"}, **kw)
    found = run.groupBy(key).agg(
        F.sum((F.col("__upto") - F.col("__ones")) * F.col("__zeros")).cast("long").alias("n_inversions")
    )
    same = base.groupBy(key, "__o").agg(F.count(F.lit(1)).alias("__c")).groupBy(key).agg(
        F.sum(F.col("__c") * F.col("__c")).alias("__sq")
    )
    return (
        lows.select(key, "n_rows").join(same, key).join(found, key, "left")
        .select(
            key, "n_rows",
            F.floor((F.col("n_rows") * F.col("n_rows") - F.col("__sq")) / 2).cast("long").alias("n_pairs"),
            F.coalesce(F.col("n_inversions"), F.lit(0)).alias("n_inversions"),
        )
    )
