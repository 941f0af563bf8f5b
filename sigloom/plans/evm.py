"""Earned-value and lifecycle metrics over monthly snapshot tables.

A snapshot table has one row per entity and month, so windows per entity are bounded by months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions.buckets import spi_state
from sigloom.functions.clean import col


def month_index(date) -> Column:
    return F.year(col(date)) * 12 + F.month(col(date)) - 1


def month_spine(entities: DataFrame, entity: str, start: str, end: str, month: str = "month") -> DataFrame:
    """Every month of each entity's span."""
    e = entities.filter(F.col(end) >= F.col(start))
    return e.select(entity, F.explode(F.sequence(month_index(start), month_index(end))).alias(month))


def month_map(month: str, names: Sequence[str]) -> Column:
    """The columns of an entity's months as a map, for rows with one row per entity and month; bounded by its months."""
    entry = F.when(F.col(month).isNotNull(), F.struct(F.col(month).alias("key"), F.struct(*names).alias("value")))
    return F.map_from_entries(F.collect_list(entry))


def _by_month(entity: str, month: str):
    return W.partitionBy(entity).orderBy(month)


def values(df: DataFrame, pct: str, planned_pct: str, budget: str) -> DataFrame:
    return df.withColumns({"planned_value": F.col(planned_pct) * F.col(budget), "earned_value": F.col(pct) * F.col(budget)})


def indices(df: DataFrame, pct: str, planned_pct: str, cost: str) -> DataFrame:
    """SPI and BPI, at most 2; 1 while nothing is planned or spent."""
    return df.withColumns(
        {
            "spi": F.when(F.col(planned_pct) > 0, F.least(F.lit(2.0), F.col(pct) / F.col(planned_pct))).otherwise(1.0),
            "bpi": F.when(F.col(cost) > 0, F.least(F.lit(2.0), F.col("earned_value") / F.col(cost))).otherwise(1.0),
        }
    )


def eac(df: DataFrame, spend: str, budget: str, bpi: str, lifecycle: str, out: str = "eac") -> DataFrame:
    eff = F.greatest(F.lit(0.70), 0.95 - 0.25 * F.col(lifecycle))
    rest = F.greatest(F.lit(0.0), F.col(budget) - F.col(spend))
    value = F.greatest(F.col(budget), F.col(spend) + rest * eff / F.col(bpi))
    return df.withColumn(out, F.when(F.col(bpi) > 0, value).otherwise(1.5 * F.col(budget)))


def days_behind(df: DataFrame, entity: str, month: str, sim_month: str, spi: str, out: str = "days_behind") -> DataFrame:
    """Behind schedule the days follow from the SPI; ahead of it they are worked off.

    The recursion max(0, previous - recovered) equals the last behind value minus all that was
    recovered since, floored at 0: two windows instead of a loop.
    """
    behind = F.col(spi) < 1.0
    planned = F.col(sim_month) * 30
    lost = F.greatest(F.lit(0), F.floor(planned / F.greatest(F.lit(0.5), F.col(spi)) - planned)).cast("int")
    recovered = F.floor(5 * (F.col(spi) - 1.0) * 30).cast("int")
    w = _by_month(entity, month).rowsBetween(W.unboundedPreceding, W.currentRow)
    df = df.withColumn("__run", F.sum(F.when(behind, 1).otherwise(0)).over(w))
    seg = W.partitionBy(entity, "__run").orderBy(month).rowsBetween(W.unboundedPreceding, W.currentRow)
    base = F.coalesce(F.max(F.when(behind, lost)).over(seg), F.lit(0))
    back = F.sum(F.when(behind, 0).otherwise(recovered)).over(seg)
    return df.withColumn(out, F.greatest(F.lit(0), base - back).cast("int")).drop("__run")


def float_consumed(df: DataFrame, snapshot: str, target: str, behind: str = "days_behind") -> DataFrame:
    slack = F.greatest(F.lit(1), F.datediff(target, snapshot))
    return df.withColumn("pct_float_consumed", F.least(F.lit(1.0), F.col(behind) / slack))


def composite_risk(spi, bpi, open_items, rate3) -> Column:
    late = F.greatest(F.lit(0.0), 1.0 - col(spi))
    over = F.greatest(F.lit(0.0), 1.0 - col(bpi))
    load = F.least(F.lit(1.0), col(open_items) / F.greatest(F.lit(1.0), col(rate3) * 3))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.4 * late + 0.4 * over + 0.2 * load))


def state_transitions(df: DataFrame, entity: str, month: str, spi: str, digits: int = 6) -> DataFrame:
    """Empirical probability of each SPI state after each other one."""
    df = df.select(entity, month, spi_state(spi).alias("to_state"))
    df = df.withColumn("from_state", F.lag("to_state").over(_by_month(entity, month))).filter("from_state IS NOT NULL")
    n = df.groupBy("from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("prob", F.round(F.col("n") / F.sum("n").over(W.partitionBy("from_state")), digits))


def open_backlog(spine: DataFrame, events: DataFrame, entity: str, created: str, resolved: str, month: str = "month") -> DataFrame:
    """Items created and not yet resolved at each month end.

    Events become monthly +1 / -1 sums before they meet the spine.
    """
    marks = events.select(
        entity,
        F.explode(
            F.array(
                F.struct(month_index(created).alias("m"), F.lit(1).alias("d")),
                F.struct(month_index(resolved).alias("m"), F.lit(-1).alias("d")),
            )
        ).alias("x"),
    ).filter("x.m IS NOT NULL")
    marks = marks.groupBy(entity, F.col("x.m").alias(month)).agg(F.sum("x.d").alias("__d"))
    both = spine.select(entity, month, F.lit(1).alias("__s"), F.lit(0).cast("long").alias("__d")).unionByName(
        marks.select(entity, month, F.lit(0).alias("__s"), "__d")
    )
    # dealt once, by what the window needs
    both = both.repartition(entity).groupBy(entity, month).agg(F.max("__s").alias("__s"), F.sum("__d").alias("__d"))
    w = _by_month(entity, month).rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn("open_items", F.sum("__d").over(w)).filter("__s = 1").select(entity, month, "open_items")


def monthly_burn(df: DataFrame, entity: str, month: str, spend: str, out: str = "monthly_burn") -> DataFrame:
    before = F.coalesce(F.lag(spend).over(_by_month(entity, month)), F.lit(0.0))
    return df.withColumn(out, F.greatest(F.lit(0.0), F.col(spend) - before))


def guardrails(df: DataFrame, entity: str, month: str) -> DataFrame:
    """Progress never falls; EAC, burn, SPI, BPI and the target date stay within their limits."""
    w = _by_month(entity, month).rowsBetween(W.unboundedPreceding, W.currentRow)

    def band(c):
        return F.greatest(F.lit(0.5), F.least(F.lit(1.5), F.col(c)))

    return df.withColumns(
        {
            "pct_complete": F.max(F.least(F.lit(1.0), F.col("pct_complete"))).over(w),
            "eac": F.least(F.col("eac"), 1.08 * F.col("amt_contract")),
            "monthly_burn": F.least(F.col("monthly_burn"), 0.08 * F.col("amt_contract")),
            "spi": band("spi"),
            "bpi": band("bpi"),
            "current_tco": F.greatest("current_tco", "original_tco"),
        }
    )


def rebaseline_audit(df: DataFrame, entity: str, month: str, flag: str, spi: str, target: str, open_items: str) -> DataFrame:
    """Verdict on each re-versioning month from the six months that follow it."""
    w = _by_month(entity, month)

    def ahead(n: int):
        return w.rangeBetween(1, n)

    two, three, four, six = (ahead(n) for n in (2, 3, 4, 6))
    df = df.withColumns(
        {
            "n_after": F.count(F.lit(1)).over(six),
            "recovered": F.coalesce(F.max(F.when(F.col(spi) > 0.92, 1).otherwise(0)).over(three), F.lit(0)) == 1,
            "stable": F.size(F.collect_set(target).over(four)) <= 1,
            "__low": F.min(open_items).over(two),
        }
    ).filter(F.col(flag))
    now = F.col(open_items)
    resolved = F.coalesce((now > 0) & ((now - F.col("__low")) / F.when(now > 0, now) >= 0.20), F.lit(False))
    df = df.withColumn("resolved", resolved)
    r, s, o = F.col("recovered"), F.col("stable"), F.col("resolved")
    verdict = (
        F.when(F.col("n_after") < 3, "inconclusive")
        .when(r & ~s & ~o, "premature")
        .when(s & (o | ~r), "justified")
        .when(o, "justified")
        .otherwise("inconclusive")
    )
    return df.select(entity, month, "n_after", "recovered", "stable", "resolved", verdict.alias("verdict"))


def cost_flags(eac_col, contract) -> dict[str, Column]:
    share = col(eac_col) / F.greatest(F.lit(1.0), col(contract))
    return {"eac_contract_ratio": share, "is_at_risk": share > 1.00, "is_distressed": share > 1.02}


def change_order_rollup(cos: DataFrame, entity: str, month: str, status: str, amount: str, statuses: Sequence[str] = ("approved", "pending")) -> DataFrame:
    """Running count and value per status, one row per entity and month with orders."""
    aggs = []
    for s in statuses:
        hit = F.col(status) == s
        aggs += [F.count_if(hit).alias(f"__n_{s}"), F.sum(F.when(hit, F.col(amount)).otherwise(0.0)).alias(f"__a_{s}")]
    per = cos.groupBy(entity, month).agg(*aggs)
    w = _by_month(entity, month).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = {}
    for s in statuses:
        out[f"n_{s}"] = F.sum(f"__n_{s}").over(w)
        out[f"amt_{s}"] = F.sum(f"__a_{s}").over(w)
    return per.withColumns(out).select(entity, month, *out)


def registry(df: DataFrame, entity: str, month: str, final: Sequence[str], totals: dict[str, Column] | None = None) -> DataFrame:
    """Final-state row per entity."""
    aggs = [F.max_by(F.struct(*final), month).alias("__f"), F.count(F.lit(1)).alias("n_months")]
    aggs += [c.alias(n) for n, c in (totals or {}).items()]
    out = df.groupBy(entity).agg(*aggs)
    return out.select(entity, "n_months", *[F.col(f"__f.{c}").alias(f"final_{c}") for c in final], *(totals or {}))
