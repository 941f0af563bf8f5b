"""Lifecycle checks per entity, as group-bys and windows over all entities at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.operators.joins import daily_counts, window_counts
from sigloom.operators.quantiles import exact_quantiles
from sigloom.operators.setops import union_all
from sigloom.operators.windows import inversions, thirds
from sigloom.plans.evm import month_index


def sequencing(rows: DataFrame, order: str, start: str, entity: str = "entity_id", limit: float = 0.40, min_rows: int = 3, digits: int = 3) -> DataFrame:
    """Share of ordered pairs that start in the wrong order."""
    inv = inversions(rows, entity, order, start).filter(F.col("n_rows") >= min_rows)
    rate = F.when(F.col("n_pairs") > 0, F.col("n_inversions") / F.col("n_pairs")).otherwise(0.0)
    return inv.withColumns({"inversion_rate": F.round(rate, digits), "passed": rate <= limit})


def envelope_alignment(events: DataFrame, work: DataFrame, created: str, start: str, end: str, entity: str = "entity_id", buffer: int = 30, floor: float = 0.90, digits: int = 3) -> DataFrame:
    """Share of events inside the envelope of the entity's work packages."""
    env = work.groupBy(entity).agg(F.min(start).alias("__s"), F.max(end).alias("__e"))
    days = daily_counts(events, entity, F.col(created)).join(env, entity)
    inside = F.col("day").between(F.date_sub("__s", buffer), F.date_add("__e", buffer))
    out = days.groupBy(entity).agg(F.sum("n").alias("n_events"), F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("n_inside"))
    rate = F.col("n_inside") / F.col("n_events")
    return out.withColumns({"alignment_rate": F.round(rate, digits), "passed": rate >= floor})


def scurve_shape(ledger: DataFrame, date: str, cost: str, entity: str = "entity_id", front: float = 0.50, late: float = 0.55, min_months: int = 4, digits: int = 1) -> DataFrame:
    """Spend at the first and third quarter against the peak of the running maximum.

    The pick is the row at index n div 4 (at least 1) and 3n div 4, counted from 0.
    """
    per = ledger.groupBy(entity, month_index(date).alias("month")).agg(F.sum(cost).alias("__c"))
    w = W.partitionBy(entity).orderBy("month")
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    per = per.withColumns({"__m": F.max("__c").over(upto), "__i": F.row_number().over(w) - 1, "__n": F.count(F.lit(1)).over(W.partitionBy(entity))})
    q1 = F.greatest(F.lit(1), F.floor(F.col("__n") / 4))
    q3 = F.least(F.col("__n") - 1, F.floor(F.col("__n") * 3 / 4))
    out = per.groupBy(entity).agg(
        F.max("__n").alias("n_months"), F.max("__m").alias("peak"),
        F.max(F.when(F.col("__i") == q1, F.col("__m"))).alias("__q1"), F.max(F.when(F.col("__i") == q3, F.col("__m"))).alias("__q3"),
    ).filter((F.col("n_months") >= min_months) & (F.col("peak") > 0))
    a, b = F.col("__q1") / F.col("peak"), F.col("__q3") / F.col("peak")
    return out.select(
        entity, "n_months", F.round(a * 100, digits).alias("q1_pct"), F.round(b * 100, digits).alias("q3_pct"),
        (a > front).alias("front_loaded"), (b < late).alias("no_convergence"), ((a <= front) & (b >= late)).alias("passed"),
    )


def anchor_spike(events: DataFrame, anchors: DataFrame, entities: DataFrame, created: str, at: str, entity: str = "entity_id", window: int = 30, floor: float = 0.8, digits: int = 2) -> DataFrame:
    """Events near anchors over the number expected if events were spread evenly. An event near two
    anchors counts twice, as each anchor brings its own window."""
    ev, an = daily_counts(events, entity, F.col(created)), daily_counts(anchors, entity, F.col(at))
    near = window_counts(ev, an, entity, {"__w": (-window, window)})
    near = near.groupBy(entity).agg(F.sum(F.col("__w") * F.col("n_anchor")).alias("near"), F.sum("n_anchor").alias("n_anchors"))
    total = ev.groupBy(entity).agg(F.sum("n").alias("n_events"))
    e = entities.select(entity, F.datediff("dt_end", "dt_start").alias("__d")).filter("__d > 0")
    out = total.join(near, entity).join(e, entity)
    expected = F.col("n_events") * (F.col("n_anchors") * (2 * window) / F.col("__d"))
    ratio = F.col("near") / expected
    return out.select(entity, "n_anchors", "n_events", "near", F.round(ratio, digits).alias("spike_ratio"), (ratio >= floor).alias("passed"))


def phase_progression(rows: DataFrame, order: str, start: str, entity: str = "entity_id", tie: str | None = None, min_rows: int = 6) -> DataFrame:
    """Median start of the first, middle and last third of the sequence, which should not go back."""
    keep = [entity, order, *([tie] if tie else []), start]
    ph = thirds(rows.select(*dict.fromkeys(keep)), [entity], [order, *([tie] if tie else [])])
    med = exact_quantiles(ph.select(entity, "phase", F.unix_date(start).alias("__d")), [entity, "phase"], "__d", {"m": 0.5}, count="k")
    out = med.groupBy(entity).agg(
        F.sum("k").alias("n_rows"),
        *[F.max(F.when(F.col("phase") == p, F.col("m"))).alias(f"{p}_median") for p in ("early", "mid", "late")],
    ).filter(F.col("n_rows") >= min_rows)
    a, b = F.col("early_median") <= F.col("mid_median"), F.col("mid_median") <= F.col("late_median")
    return out.withColumns({"early_before_mid": a, "mid_before_late": b, "passed": a & b})


def budget_alignment(work: DataFrame, ledger: DataFrame, date: str, cost: str, estimate: str, entity: str = "entity_id", limit: float = 0.30, digits: int = 1) -> DataFrame:
    """Percent of tasks done against percent of the peak estimate spent."""
    s = work.groupBy(entity).agg(F.sum("n_completed").alias("__c"), F.sum("n_total").alias("__t"))
    per = ledger.groupBy(entity, month_index(date).alias("month")).agg(F.sum(cost).alias("__j"), F.sum(estimate).alias("__x"))
    b = per.groupBy(entity).agg(F.max("__j").alias("__j"), F.max("__x").alias("__x"))
    out = s.join(b, entity)
    sched = F.when(F.col("__t") > 0, F.col("__c") / F.col("__t")).otherwise(0.0)
    spent = F.when(F.col("__x") > 0, F.col("__j") / F.col("__x")).otherwise(0.0)
    gap = F.abs(sched - spent)
    return out.select(
        entity, F.round(sched * 100, digits).alias("schedule_pct"), F.round(spent * 100, digits).alias("budget_pct"),
        F.round(gap * 100, digits).alias("gap_pct"), (gap <= limit).alias("passed"),
    )


def trade_mix(events: DataFrame, trade: str, named: tuple[str, str] = ("D SERVICES", "C INTERIORS"), entity: str = "entity_id", floor: float = 0.40, digits: int = 1) -> DataFrame:
    """Share of two named trades, and the most frequent one (first by name on ties)."""
    per = events.groupBy(entity, trade).agg(F.count(F.lit(1)).alias("__n"))
    n = F.sum("__n")
    out = per.groupBy(entity).agg(
        n.alias("n_events"),
        *[F.sum(F.when(F.col(trade) == t, F.col("__n")).otherwise(0)).alias(f"__t{i}") for i, t in enumerate(named)],
        F.min_by(trade, F.struct(-F.col("__n"), F.col(trade))).alias("top_trade"),
    )
    a, b = F.col("__t0") / F.col("n_events"), F.col("__t1") / F.col("n_events")
    share = (F.col("__t0") + F.col("__t1")) / F.col("n_events")
    return out.select(
        entity, "n_events", F.round(a * 100, digits).alias("first_pct"), F.round(b * 100, digits).alias("second_pct"),
        F.round(share * 100, digits).alias("combined_pct"), "top_trade", (share >= floor).alias("passed"),
    )


def timeline(entities: DataFrame, events: DataFrame | None, work: DataFrame | None, ledger: DataFrame | None, *, created: str = "created", start: str = "sow_start", end: str = "sow_finish", date: str = "dt_budget", cost: str = "amt_jtd", entity: str = "entity_id") -> DataFrame:
    """Events, open work packages and spend for every month of an entity; NULL for an absent table.

    Work packages become +1 / -1 marks at their first month and after their last one.
    """
    e = entities.filter(F.col("dt_end") >= F.col("dt_start"))
    spine = e.select(entity, F.explode(F.sequence(month_index("dt_start"), month_index("dt_end"))).alias("month"))
    out = spine
    if work is not None:
        marks = work.select(
            entity,
            F.explode(
                F.array(
                    F.struct(month_index(start).alias("m"), F.lit(1).alias("d")),
                    F.struct((month_index(end) + 1).alias("m"), F.lit(-1).alias("d")),
                )
            ).alias("x"),
        )
        marks = marks.groupBy(entity, F.col("x.m").alias("month")).agg(F.sum("x.d").alias("__d"))
        both = spine.withColumns({"__s": F.lit(1), "__d": F.lit(0).cast("long")}).unionByName(
            marks.select(entity, "month", F.lit(0).alias("__s"), "__d")
        )
        both = both.groupBy(entity, "month").agg(F.max("__s").alias("__s"), F.sum("__d").alias("__d"))
        w = W.partitionBy(entity).orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
        out = both.withColumn("n_active_sows", F.sum("__d").over(w)).filter("__s = 1").select(entity, "month", "n_active_sows")
    else:
        out = out.withColumn("n_active_sows", F.lit(None).cast("long"))
    if events is not None:
        n = events.groupBy(entity, month_index(created).alias("month")).agg(F.count(F.lit(1)).alias("n_events"))
        out = out.join(n, [entity, "month"], "left")
    else:
        out = out.withColumn("n_events", F.lit(None).cast("long"))
    if ledger is not None:
        c = ledger.groupBy(entity, month_index(date).alias("month")).agg(F.sum(cost).alias("spend"))
        out = out.join(c, [entity, "month"], "left")
    else:
        out = out.withColumn("spend", F.lit(None).cast("double"))
    label = F.concat(F.floor(F.col("month") / 12).cast("string"), F.lit("-"), F.lpad((F.col("month") % 12 + 1).cast("string"), 2, "0"))
    return out.select(entity, "month", label.alias("month_str"), "n_events", "n_active_sows", "spend")


def event_density(line: DataFrame, entity: str = "entity_id", limit: float = 0.10, digits: int = 3) -> DataFrame:
    """Share of core months (without the first and last) that have no open work package."""
    span = line.groupBy(entity).agg(F.min("month").alias("__lo"), F.max("month").alias("__hi"), F.count(F.lit(1)).alias("total_months"))
    core = line.join(span.filter("total_months > 2"), entity).filter((F.col("month") > F.col("__lo")) & (F.col("month") < F.col("__hi")))
    out = core.groupBy(entity).agg(
        F.max("total_months").alias("total_months"), F.count(F.lit(1)).alias("core_months"), F.count_if(F.col("n_active_sows") == 0).alias("dead_months")
    )
    rate = F.col("dead_months") / F.col("core_months")
    return out.withColumns({"dead_rate": F.round(rate, digits), "passed": rate <= limit})


def summary(results: Mapping[str, DataFrame]) -> DataFrame:
    """Passed and checked entities per trace check."""
    parts = [
        df.agg(F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_checked")).withColumn("check", F.lit(name))
        for name, df in results.items()
    ]
    pct = F.when(F.col("n_checked") > 0, F.round(F.col("n_passed") * 100.0 / F.col("n_checked"), 1))
    return union_all(parts).select("check", "n_passed", "n_checked", pct.alias("pct"))
