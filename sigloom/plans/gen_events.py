"""Event generator: counts, structured fields, anchors, follow-ups, text batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions import clean, draws, values
from sigloom.operators.joins import daily_counts, near_anchor
from sigloom.operators.lookup import fallback_bounds
from sigloom.operators.ordered import ordered, spread

E = "entity_id"
NEAR_DAYS = 30
COUNT_CHAIN = (("SBU_SIZE", ("sbu", "size_category")), ("SBU", ("sbu",)), ("GLOBAL", ()))


def _known(b: Column, name: str, default: float) -> Column:
    return F.coalesce(b[name], F.lit(float(default)))


def event_count(entities: DataFrame, constraints: DataFrame, anchors: DataFrame | None = None, spike: Mapping[str, float] | None = None) -> DataFrame:
    """Lognormal event count; entities with anchors are lifted by a drawn spike ratio, within the cap."""
    d = values.DEFAULT_COUNT_BOUNDS
    got = fallback_bounds(entities, constraints, "n_events_per_entity", chain=COUNT_CHAIN, out="__b")
    b = F.col("__b")
    got = got.withColumns({f"__{k}": _known(b, k, d[k]) for k in ("p25", "median", "p75")})
    n = draws.count_from_quartiles([E], "n_events", "__p25", "__median", "__p75")
    if anchors is not None:
        s = dict(spike or values.DEFAULT_SPIKE_BOUNDS)
        ratio = draws.lognormal([E], "spike", F.lit(s["p25"]), F.lit(s["median"]), F.lit(s["p75"]), shift=0.01)
        ratio = F.least(F.lit(2.0), F.greatest(F.lit(0.5), ratio))
        has = anchors.select(E).distinct().withColumn("__has", F.lit(True))
        got = got.join(has, E, "left")
        cap = F.floor(F.col("__p75") * 1.15).cast("int")
        n = F.when(F.col("__has"), F.greatest(F.lit(1), F.least((n * ratio).cast("int"), cap))).otherwise(n)
    return got.withColumn("n_events", n).select(*entities.columns, "n_events")


def _shares(table: DataFrame, key: str, item: str, weight: str, out: str) -> DataFrame:
    return table.groupBy(key).agg(draws.menu(item, weight).alias(out))


def event_date(zone: Column, pct: Column, start: Column, end: Column, sow: Column, u: Column) -> Column:
    """Day in the zone of the work package, clipped to the entity; without one, by lifecycle percent."""
    lead = F.greatest(F.lit(14), F.least(F.lit(60), (F.datediff(sow["sow_start"], start) * 0.15).cast("int")))
    lo = F.when(zone == "pre_sow", F.date_sub(sow["sow_start"], lead)).when(zone == "post_sow", F.date_add(sow["sow_finish"], 1)).otherwise(sow["sow_start"])
    hi = F.when(zone == "pre_sow", F.date_sub(sow["sow_start"], 1)).when(zone == "post_sow", F.date_add(sow["sow_finish"], 30)).otherwise(sow["sow_finish"])
    lo, hi = F.greatest(lo, start), F.least(hi, end)
    placed = F.date_add(lo, F.floor(u * (F.datediff(hi, lo) + 1)).cast("int"))
    by_share = F.date_add(start, (pct / 100.0 * F.datediff(end, start)).cast("int"))
    return F.least(F.greatest(F.when(sow.isNotNull() & (lo <= hi), placed).otherwise(by_share), start), end)


def status_rules(status: Column, created: Column, due: Column, start: Column, end: Column, u: Column, late_share: float = 0.15) -> Column:
    """Open events of the last 30 % whose due date has come may be overdue."""
    progress = F.datediff(created, start) / F.greatest(F.datediff(end, start), F.lit(1))
    late = (status == "open") & (progress >= 0.70) & (due < end) & (u < late_share)
    return F.when(late, "overdue").otherwise(status)


def matching_sows(trade: Column, sows: Column, mapping: Mapping[str, Sequence[str]]) -> Column:
    """The entity's work packages whose label contains one of the trade's."""
    names = F.try_element_at(F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*[F.lit(i) for i in v]))]), trade)
    return F.filter(sows, lambda s: F.exists(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.contains(s["sow"], n)))


def generate(
    entities: DataFrame, constraints: DataFrame, trades: DataFrame, lifecycle: DataFrame, zones: DataFrame, statuses: DataFrame, flags: DataFrame,
    work: DataFrame, anchors: DataFrame, resolution: Mapping[str, float] | None = None, mapping: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Structured events. `work` are the active work packages, `anchors` the re-versioning days (column `day`)."""
    key = [E, "seq"]
    res = dict(resolution or values.DEFAULT_RESOLUTION_BOUNDS)
    sows = work.groupBy(E).agg(F.sort_array(F.collect_list(F.struct("sow", "sow_start", "sow_finish"))).alias("__sows"))  # a vocabulary per entity
    weights = _shares(trades.filter("level = 'SBU'"), "sbu", "trade", "pct_of_sbu", "__tw")
    overall = trades.filter("level = 'GLOBAL'").agg(draws.menu("trade", "pct_of_sbu")).scalar()
    status = _shares(statuses, "sbu", "status_simplified", "pct", "__st")
    e = event_count(entities.filter(F.datediff("dt_end", "dt_start") > 0), constraints, anchors)
    days = anchors.filter("day IS NOT NULL").groupBy(E).agg(F.collect_set("day").alias("__anchors"))
    e = e.join(sows, E, "left").join(days, E, "left").join(weights, "sbu", "left").join(status, "sbu", "left").withColumn("__tw", F.coalesce("__tw", overall))
    df = spread(e, E).withColumn("seq", F.explode(F.sequence(F.lit(1), F.col("n_events")))).drop("n_events")
    # draws that folds read are made below the joins, in compiled code
    df = df.withColumns({"trade": draws.from_menu(draws.uniform(key, "trade"), "__tw"), "__uz": draws.uniform(key, "zone"), "__us": draws.uniform(key, "status")}).drop("__tw")
    beta = lifecycle.select("trade", *[F.col(c).alias(f"__{c}") for c in ("p10", "p25", "median", "p75", "p90")])
    df = df.join(beta, "trade", "left").join(_shares(zones, "trade", "zone", "pct_of_trade", "__zw"), "trade", "left")
    df = df.join(flags.select("trade", F.col("pct_flag").alias("__flag")), "trade", "left")
    # a trade without a profile: a symmetric draw over the whole span
    shape = draws.beta_parameters("__p10", "__p25", "__median", "__p75", "__p90")
    known = shape["low"].isNotNull() | shape["top"].isNotNull()
    x = draws.beta_quantile(draws.uniform(key, "lifecycle"), F.when(known, shape["alpha"]).otherwise(2.0), F.when(known, shape["beta"]).otherwise(2.0))
    df = df.withColumn("__x", x)
    pct = F.least(F.greatest(shape["low"] + F.col("__x") * shape["width"], shape["low"]), shape["top"])
    default_zone = draws.categorical(F.col("__uz"), values.DEFAULT_ZONE_SHARES, None)
    df = df.withColumns(
        {
            "lifecycle_pct": F.coalesce(pct, 165.0 * F.col("__x")),
            "zone": F.coalesce(draws.from_menu(F.col("__uz"), "__zw"), default_zone),
            "__fit": matching_sows(F.col("trade"), F.coalesce(F.col("__sows"), F.array().cast("array<struct<sow:string,sow_start:date,sow_finish:date>>")), mapping or values.TRADE_TO_SOW),
        }
    )
    pool = F.when(F.size("__fit") > 0, F.col("__fit")).otherwise(F.col("__sows"))
    df = df.withColumn("__pool", pool)
    at = F.floor(draws.uniform(key, "sow") * F.size("__pool")).cast("int") + 1
    df = df.withColumn("__sow", F.try_element_at("__pool", F.when(F.size("__pool") > 0, at)))
    created = event_date(F.col("zone"), F.col("lifecycle_pct"), F.col("dt_start"), F.col("dt_end"), F.col("__sow"), draws.uniform(key, "day"))
    df = df.withColumns({"created": created, "sow": F.col("__sow.sow")})
    due = F.least(F.date_add("created", draws.pick(key, "due", values.DUE_DAY_OPTIONS)), F.col("dt_end"))
    drawn = F.coalesce(draws.from_menu(F.col("__us"), "__st"), draws.categorical(F.col("__us"), values.DEFAULT_STATUS_SHARES, None))
    df = df.withColumns({"due": due, "__drawn": drawn})
    days = draws.count_from_quartiles(key, "resolution", F.lit(res["p25"]), F.lit(res["median"]), F.lit(res["p75"]), cap_of=F.lit(res["p90"]))
    df = df.withColumns(
        {
            "resolved": F.when(F.col("__drawn") == "closed", F.least(F.date_add("created", days), F.col("dt_end"))),
            "status": status_rules(F.col("__drawn"), F.col("created"), F.col("due"), F.col("dt_start"), F.col("dt_end"), draws.uniform(key, "overdue")),
            "is_flagged": draws.uniform(key, "flag") < F.coalesce(F.col("__flag") / 100.0, F.lit(values.DEFAULT_FLAG_RATE)),
            "timing": F.when(F.col("zone") == "pre_sow", "Pre-SOW").when(F.col("zone") == "post_sow", "Post-SOW").otherwise("During"),
        }
    )
    # an entity's re-versioning days are as few as its versions, and its events are not dealt anew for them
    near = F.exists("__anchors", lambda day: F.datediff("created", day).between(0, NEAR_DAYS))
    df = df.withColumn("is_near", F.coalesce(near, F.lit(False)))
    return df.select(
        E, "seq", event_key("sbu", E, "seq").alias("event_id"), "sbu", "dt_start", "dt_end", "created", "due", "resolved", "status", "trade", "sow",
        "timing", "zone", "is_flagged", "is_near", F.lit(None).cast("string").alias("parent_id"),
    )


def event_key(unit, entity, number) -> Column:
    return F.concat_ws("-", F.lit("SYN"), clean.short_code(unit), F.col(entity).cast("string"), F.lit("RFI"), clean.zero_filled(number, 4))


def with_near_flag(df: DataFrame, anchors: DataFrame, window: int = NEAR_DAYS, created: str = "created", entity: str = E) -> DataFrame:
    """True within 30 days after an anchor. Decided per (entity, day), then joined on both."""
    days = df.select(entity, F.col(created).alias("day")).distinct()
    near = near_anchor(days, anchors.select(entity, "day").distinct(), entity, 0, window)
    near = near.select(F.col(entity).alias("__e"), F.col("day").alias("__day"), "is_near")
    return df.join(near, (F.col(entity) == F.col("__e")) & (F.col(created) == F.col("__day")), "left").drop("__e", "__day")


def follow_ups(events: DataFrame, share: float = 0.10, gap: tuple[int, int] = (7, 21), resolution: Mapping[str, float] | None = None) -> DataFrame:
    """Chained events: a tenth of the closed and overdue ones are asked again 7 to 21 days later."""
    res = dict(resolution or values.DEFAULT_RESOLUTION_BOUNDS)
    key = ["event_id"]
    df = events.filter(F.col("status").isin("closed", "overdue") & (draws.uniform(key, "chain") < share))
    df = df.withColumns({"parent_id": F.col("event_id"), "created": F.date_add("created", draws.integer(key, "chain:gap", *gap))})
    df = df.filter(F.col("created") <= F.col("dt_end"))
    due = F.least(F.date_add("created", draws.pick(key, "chain:due", values.DUE_DAY_OPTIONS)), F.col("dt_end"))
    drawn = draws.categorical(draws.uniform(key, "chain:status"), values.DEFAULT_STATUS_SHARES, None)
    df = df.withColumns({"due": due, "__drawn": drawn})
    days = draws.count_from_quartiles(key, "chain:resolution", F.lit(res["p25"]), F.lit(res["median"]), F.lit(res["p75"]), cap_of=F.lit(res["p90"]))
    df = df.withColumns(
        {
            "resolved": F.when(F.col("__drawn") == "closed", F.least(F.date_add("created", days), F.col("dt_end"))),
            "status": status_rules(F.col("__drawn"), F.col("created"), F.col("due"), F.col("dt_start"), F.col("dt_end"), draws.uniform(key, "chain:overdue")),
        }
    ).drop("__drawn")
    # an entity's events are capped by its profile, and follow-ups are a tenth of them
    n = events.groupBy(E).agg(F.max("seq").alias("__n"))
    df = df.join(n, E).withColumn("seq", (F.row_number().over(W.partitionBy(E).orderBy("seq")) + F.col("__n")).cast("int")).drop("__n")
    return df.withColumn("event_id", event_key("sbu", E, "seq")).select(*events.columns)


def balanced_categories(df: DataFrame, group: str, key: str, number: str, categories: DataFrame, item: str = "code", out: str = "category") -> DataFrame:
    """Deal a group's categories to its rows in turn, so that their counts differ by one at most.

    Turn order is the row number in the group, sliced when a group is long.
    """
    menu = categories.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("__menu"))  # the vocabulary of the group
    got = ordered(df.withColumn("__h", F.xxhash64(F.lit(draws.SEED), F.col(key), F.lit("deal"))), [group], ["__h", number], row_number="__i")
    got = got.join(menu, group, "left")
    return got.withColumn(out, F.element_at("__menu", (F.col("__i") - 1) % F.size("__menu") + 1)).drop("__h", "__i", "__menu")


def text_batches(events: DataFrame, parts: Sequence[str], number: str, trade: str = "trade", zone: str = "zone", sow: str = "sow", min_group: int = 5, size: int = 20) -> DataFrame:
    """Batch number per event. Groups of five or more stay together; smaller ones share a catch-all
    per trade that takes the most frequent zone and work package."""
    cell = [*parts, trade, zone, sow]
    n = events.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"))
    small = n.filter(F.col("__n") < min_group)

    def top(x: str) -> DataFrame:
        c = small.groupBy(*parts, trade, x).agg(F.sum("__n").alias("__c"))
        return c.groupBy(*parts, trade).agg(F.min_by(x, F.struct(-F.col("__c"), F.col(x))).alias(f"rep_{x}"))

    rep = top(zone).join(top(sow), [*parts, trade])
    df = events.join(n, cell).join(rep, [*parts, trade], "left")
    alone = F.col("__n") >= min_group
    df = df.withColumns(
        {
            "is_catchall": ~alone,
            "group_zone": F.when(alone, F.col(zone)).otherwise(F.col(f"rep_{zone}")),
            "group_sow": F.when(alone, F.col(sow)).otherwise(F.col(f"rep_{sow}")),
        }
    ).drop("__n", f"rep_{zone}", f"rep_{sow}")
    got = ordered(df, [*parts, trade, "group_zone", "group_sow", "is_catchall"], [number], row_number="__i")
    return got.withColumn("batch", F.ceil(F.col("__i") / size).cast("int")).drop("__i")


def examples_for(cells: DataFrame, pool: DataFrame, trade: str = "trade", unit: str = "sbu", tie: str = "example_id", n: int = 3) -> DataFrame:
    """n examples per cell: its own first, then the trade's other ones. The pool holds ten per cell."""
    p = pool.select(F.col(trade).alias("__t"), F.col(unit).alias("__u"), *[c for c in pool.columns if c not in (trade, unit)])
    both = cells.join(p, F.col(trade) == F.col("__t"))
    own = (F.col(unit) == F.col("__u")).cast("int")
    order = [F.desc(own), draws.uniform([trade, unit, tie], "example"), F.col(tie)]
    rank = F.row_number().over(W.partitionBy(trade, unit).orderBy(*order))
    return both.withColumn("rank", rank).filter(F.col("rank") <= n).withColumn("is_own", F.col(unit) == F.col("__u")).drop("__t", "__u")
