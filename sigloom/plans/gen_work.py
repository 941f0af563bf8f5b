"""Work-package generator: choice and order, chained placement, scaling, overruns, version deltas.

An entity has at most as many work packages as the label vocabulary, and at most 65 versions;
arrays and windows per entity are bounded by that.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.functions import buckets, draws, values
from sigloom.operators.lookup import CONSTRAINT_CHAIN, fallback, fallback_bounds, pair_or_general
from sigloom.operators.ordered import spread

E, S = "entity_id", "sow"
KEY = [E, S]


def literal_map(items: Mapping) -> Column:
    return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), F.lit(v))])


def boundary(target, next_target, default) -> Column:
    """Latest of the dates that are known, else the default."""
    return F.coalesce(F.greatest(F.col(target), F.col(next_target)), F.col(default))


def min_days(sow: str = S, table: Mapping[str, int] | None = None, default: int = values.MIN_DURATION_DEFAULT) -> Column:
    return F.coalesce(F.try_element_at(literal_map(table or values.MIN_DURATIONS), F.col(sow)), F.lit(default))


def repair_dates(df: DataFrame, table: Mapping[str, int] | None = None, start: str = "sow_start", end: str = "sow_finish", days: str = "sow_days") -> DataFrame:
    """Reversed or too short windows get their minimum duration."""
    least = min_days(table=table)
    short = (F.col(end) < F.col(start)) | (F.col(days) < least)
    return df.withColumns(
        {end: F.when(short, F.date_add(start, least)).otherwise(F.col(end)), days: F.when(short, least).otherwise(F.col(days)).cast("int")}
    )


def choose(entities: DataFrame, profile: DataFrame, frequency: DataFrame) -> DataFrame:
    """Which work packages an entity has: a drawn number, weighted by frequency, without repeats."""
    q = ["p25", "median", "p75"]
    e = fallback(entities, profile, "n_sows_per_project", q, count="n_projects", prefix="__")
    n = draws.from_bounds([E], "n_sows", {"p25": F.col("__p25"), "median": F.col("__median"), "p75": F.col("__p75")})
    n = F.least(F.lit(40), F.greatest(F.lit(5), F.round(F.coalesce(n, F.lit(20.0))))).cast("int")
    e = e.withColumn("__n", n).drop(*[f"__{x}" for x in q], "__level_used")
    menu = frequency.groupBy("sbu").agg(F.collect_list(F.struct(S, F.col("pct_projects").alias("w"))).alias("__menu"))  # the vocabulary
    # a unit that the profile doesn't know, or none, chooses from the mean of all units
    overall = frequency.groupBy(S).agg(F.avg("pct_projects").alias("w")).agg(F.collect_list(F.struct(S, "w"))).scalar()
    rows = e.join(menu, "sbu", "left").withColumn("__menu", F.coalesce("__menu", overall))

    def drawn(x: Column) -> Column:
        return F.struct(draws.sampling_key([E, x[S]], "choose", x["w"]).alias("__k"), x[S].alias(S))

    # the labels are drawn inside the row, so the whole vocabulary is never dealt or sorted as rows; an id that stands in more
    # than one row still draws once, hence the largest number of them all and the rank over what is left
    rows = spread(rows, E).withColumn("__most", F.max("__n").over(W.partitionBy(E)))
    rows = rows.select("*", F.inline(F.slice(F.sort_array(F.transform("__menu", drawn)), 1, F.col("__most")))).drop("__menu", "__most")
    rank = F.row_number().over(W.partitionBy(E).orderBy("__k", S))
    return rows.withColumn("__r", rank).filter("__r <= __n").drop("__r", "__n", "__k")


def label_position(sow: str = S) -> Column:
    """Where a label stands whose positions were never seen: the first listed word that it holds decides."""
    out = None
    for words, place in values.LABEL_POSITIONS:
        holds = F.lit(False)
        for word in words:
            holds = holds | F.col(sow).contains(word)
        out = F.when(holds, place) if out is None else out.when(holds, place)
    return out.otherwise(values.LABEL_POSITION_DEFAULT).cast("double")


def arrange(rows: DataFrame, constraints: DataFrame) -> DataFrame:
    """Order by a drawn position, without bounds by the label's place; milestones are anchored at both ends."""
    got = fallback_bounds(rows, constraints, "sequence_position", chain=(("SOW_SBU", (S, "sbu")), ("GLOBAL", (S,))), out="__b")
    b = F.col("__b")
    drawn = F.round(draws.normal(KEY, "position") * F.coalesce(b["stddev"], F.lit(3.0)) + F.coalesce(b["mean"], F.lit(10.0)))
    drawn = F.least(F.greatest(drawn, F.coalesce(b["min"], F.lit(1.0))), F.coalesce(b["max"], F.lit(30.0)))
    drawn = F.when(F.size(b) > 0, drawn).otherwise(label_position())
    at = F.coalesce(F.try_element_at(literal_map(values.ANCHOR_POSITIONS), F.col(S)), drawn)
    got = got.withColumn("__at", at)
    w = W.partitionBy(E)
    return got.withColumns(
        {"seq": F.row_number().over(w.orderBy("__at", draws.uniform(KEY, "position:tie"))), "n_sows": F.count(F.lit(1)).over(w)}
    ).drop("__b", "__b_level_used", "__at")


def durations(rows: DataFrame, constraints: DataFrame, low: int = 30, high: int = 1000) -> DataFrame:
    got = fallback_bounds(rows, constraints, "sow_duration_days", chain=CONSTRAINT_CHAIN, out="__b")
    b = F.col("__b")
    v = draws.from_bounds(KEY, "duration", {"p25": b["p25"], "median": b["median"], "p75": b["p75"], "p95": b["p95"]})
    days = F.least(F.lit(high), F.greatest(F.lit(low), F.round(F.coalesce(v, F.lit(180.0))))).cast("int")
    return got.withColumn("sow_days", days).drop("__b", "__b_level_used")


def overlaps(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of the previous work package that the next one overlaps, from its pair or the general row."""
    prev = F.lag(S).over(W.partitionBy(E).orderBy("seq"))
    df = rows.withColumns({"sow_first": prev, "sow_second": F.col(S)})
    take = ["p25_pct", "median_pct", "p75_pct"]
    one = pairs.filter("level = 'GENERAL'").agg(F.max(F.struct(*take))).scalar()
    per = pairs.filter("level = 'PAIR'").select("sow_first", "sow_second", *take)
    df = pair_or_general(df, per, ["sow_first", "sow_second"], take, {c: one[c] for c in take})
    pct = draws.triangular(draws.uniform(KEY, "overlap"), "p25_pct", "median_pct", "p75_pct")
    share = F.least(F.lit(100.0), F.greatest(F.lit(-50.0), F.coalesce(pct, F.lit(84.0)))) / 100.0
    return df.withColumn("overlap", share).drop("sow_first", "sow_second", *take)


def place(rows: DataFrame, start: str = "dt_start", end: str = "boundary", late: int = 60) -> DataFrame:
    """Chain the work packages: each starts where its overlap with the previous one says; a start
    more than 60 days past the boundary is pulled back. The pull-back depends on the chain so far,
    hence a fold over the entity's sorted array."""
    cols = [c for c in rows.columns if c not in (E, "seq")]
    arr = rows.groupBy(E).agg(F.sort_array(F.collect_list(F.struct("seq", *cols))).alias("__a"))
    first = F.col("__a")[0]
    zero = F.struct(first[start].alias("prev"), F.lit(0).alias("days"), F.array().cast("array<date>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        shift = F.greatest(F.lit(0), (acc["days"] * (1 - x["overlap"])).cast("int"))
        at = F.when(F.size(acc["out"]) == 0, x[start]).otherwise(F.date_add(acc["prev"], shift))
        at = F.when((F.size(acc["out"]) > 0) & (at > F.date_add(x[end], late)), F.date_sub(x[end], late)).otherwise(at)
        return F.struct(at.alias("prev"), x["sow_days"].alias("days"), F.concat(acc["out"], F.array(at)).alias("out"))

    starts = F.aggregate("__a", zero, step)["out"]
    out = arr.withColumn("__s", starts).select(E, F.inline(F.arrays_zip("__a", "__s")))
    out = out.select(E, "__a.*", F.col("__s").alias("sow_start"))
    return out.withColumn("sow_finish", F.date_add("sow_start", F.col("sow_days")))


def scale_to_boundary(df: DataFrame, start: str = "dt_start", end: str = "boundary", floor: float = 0.50, min_len: int = 30, entity: str = E) -> DataFrame:
    """Shrink offsets and durations of entities that end past the boundary, to one half at most."""
    last = F.max("sow_finish").over(W.partitionBy(entity))
    span, actual = F.datediff(end, start), F.datediff("__last", start)
    df = df.withColumn("__last", last)
    factor = F.when((F.col("__last") > F.col(end)) & (span > 0) & (actual > 0), F.greatest(span / actual, F.lit(floor))).otherwise(1.0)
    df = df.withColumn("__f", factor)
    moved = F.col("__last") > F.col(end)
    shift = F.greatest(F.lit(0), (F.datediff("sow_start", start) * F.col("__f")).cast("int"))
    days = F.greatest(F.lit(min_len), (F.col("sow_days") * F.col("__f")).cast("int"))
    df = df.withColumns(
        {
            "sow_start": F.when(moved, F.date_add(start, shift)).otherwise(F.col("sow_start")),
            "sow_days": F.when(moved, days).otherwise(F.col("sow_days")).cast("int"),
            "was_scaled": F.col("__f") < 0.99,
        }
    )
    return df.withColumn("sow_finish", F.date_add("sow_start", F.col("sow_days"))).drop("__last", "__f")


def stretch_to_boundary(df: DataFrame, start: str = "dt_start", end: str = "boundary", gap: int = 60, limit: float = 2.5, entity: str = E) -> DataFrame:
    """Widen entities that end more than 60 days before the boundary, at most 2.5 times."""
    df = df.withColumn("__last", F.max("sow_finish").over(W.partitionBy(entity)))
    used, span = F.datediff("__last", start), F.datediff(end, start)
    factor = F.when((F.datediff(end, "__last") > gap) & (used > 0), F.least(span / used, F.lit(limit))).otherwise(1.0)
    df = df.withColumn("__f", factor)
    on = F.col("__f") != 1.0
    days = F.greatest(min_days(), (F.col("sow_days") * F.col("__f")).cast("int"))
    df = df.withColumns(
        {
            "sow_start": F.when(on, F.date_add(start, (F.datediff("sow_start", start) * F.col("__f")).cast("int"))).otherwise(F.col("sow_start")),
            "sow_days": F.when(on, days).otherwise(F.col("sow_days")).cast("int"),
        }
    )
    return df.withColumn("sow_finish", F.date_add("sow_start", F.col("sow_days"))).drop("__last", "__f")


def _overrun(i: int, sow: str = S) -> Column:
    table = {k: v[i] for k, v in values.OVERRUNS.items()}
    return F.try_element_at(literal_map(table), F.col(sow))


def overrun_or_clip(df: DataFrame, end: str = "boundary", pull: int = 30) -> DataFrame:
    """Late work packages of known kinds may overrun the boundary; the others are clipped to it."""
    late = F.col("seq") - 1 >= F.floor(F.col("n_sows") * 0.6)
    eligible = (F.datediff("sow_finish", end) > -30) | (F.col("was_scaled") & late)
    hit = _overrun(0).isNotNull() & eligible & (draws.uniform(KEY, "overrun") < _overrun(0))
    over = F.greatest(F.lit(7), draws.triangular(draws.uniform(KEY, "overrun:days"), F.lit(7.0), _overrun(1), _overrun(2)).cast("int"))
    past = ~F.coalesce(hit, F.lit(False)) & (F.col("sow_finish") > F.col(end))
    start = F.when(past & (F.col("sow_start") >= F.col(end)), F.date_sub(end, pull)).otherwise(F.col("sow_start"))
    finish = F.when(hit, F.date_add(end, over)).when(past, F.col(end)).otherwise(F.col("sow_finish"))
    df = df.withColumns({"sow_start": start, "sow_finish": finish})
    return df.withColumn("sow_days", F.datediff("sow_finish", "sow_start")).drop("was_scaled")


def task_counts(df: DataFrame, constraints: DataFrame) -> DataFrame:
    got = fallback_bounds(df, constraints, "n_tasks", chain=CONSTRAINT_CHAIN, out="__b")
    b = F.col("__b")
    v = F.round(draws.from_bounds(KEY, "n_tasks", {"p25": b["p25"], "median": b["median"], "p75": b["p75"], "p95": b["p95"]}))
    n = F.least(F.lit(10_000), F.greatest(F.lit(10), F.coalesce(v, F.lit(100.0)))).cast("int")
    marker = F.col(S).isin(*values.ANCHOR_POSITIONS)
    n = F.when(marker, draws.integer(KEY, "n_tasks:marker", 1, 9)).otherwise(n)
    return got.withColumn("n_tasks_base", n).drop("__b", "__b_level_used")


def dependency_metrics(pos, keys) -> dict[str, Column]:
    """Predecessors, successors and critical share by position in the sequence: base + uniform width."""
    # fixed values: (base, width) per quarter of the sequence
    pred = ((0.5, 1.5), (1.5, 2.0), (2.0, 2.0), (2.5, 2.5))
    succ = ((2.0, 3.0), (1.5, 2.0), (0.5, 1.5), (0.2, 1.0))
    crit = ((2.0, 4.0), (3.0, 6.0), (1.5, 3.5), (1.0, 3.0))
    out = {}
    for name, bands in (("avg_n_predecessors", pred), ("avg_n_successors", succ), ("pct_critical_path", crit)):
        u, v = draws.uniform(keys, name), None
        for edge, (base, width) in zip((0.25, 0.50, 0.75, None), bands):
            x = base + width * u
            v = F.when(pos < edge, x) if v is None else (v.when(pos < edge, x) if edge else v.otherwise(x))
        out[name] = F.round(v, 2)
    return out


def task_record(df: DataFrame, keys, avg_days: DataFrame | None = None) -> DataFrame:
    """Counts by state from the percent complete; total is always the sum of the parts."""
    pct, n = F.col("pct_complete"), F.col("n_tasks")
    cap = F.when(pct < 10, 0.025).when(pct < 50, 0.21).when(pct < 90, 0.15).otherwise(0.02)
    done = (n * pct / 100.0).cast("int")
    active = F.least((n * draws.uniform(keys, "active") * cap).cast("int"), n - done)
    df = df.withColumns({"n_completed": done, "n_active": active})
    df = df.withColumns(
        {"n_total": n, "n_not_started": n - F.col("n_completed") - F.col("n_active"), "n_early_start": (F.col("n_active") * 0.55).cast("int")}
        | dependency_metrics(F.col("seq") / F.greatest("n_sows", F.lit(1)), keys)
    )
    if avg_days is None:
        return df.withColumn("avg_duration_days", F.lit(30.0))
    q = avg_days.select(S, F.col("p25").alias("__a"), F.col("median").alias("__m"), F.col("p75").alias("__z"))
    drawn = F.round(F.greatest(F.lit(1.0), draws.triangular(draws.uniform(keys, "avg_days"), "__a", "__m", "__z")), 1)
    return df.join(q, S, "left").withColumn("avg_duration_days", F.coalesce(drawn, F.lit(30.0))).drop("__a", "__m", "__z")


def baseline(entities: DataFrame, profile: DataFrame, constraints: DataFrame, frequency: DataFrame, pairs: DataFrame) -> DataFrame:
    """Placed work packages of version 0. Entities bring dt_start, dt_end and, if known, dt_tco and dt_next_tco."""
    for c in ("dt_tco", "dt_next_tco"):
        if c not in entities.columns:
            entities = entities.withColumn(c, F.lit(None).cast("date"))
    e = entities.withColumn("boundary", boundary("dt_tco", "dt_next_tco", "dt_end"))
    rows = overlaps(durations(arrange(choose(e, profile, frequency), constraints), constraints), pairs)
    rows = overrun_or_clip(scale_to_boundary(place(rows)))
    return task_counts(repair_dates(rows), constraints)


def _lookup_by(df: DataFrame, table: DataFrame, keys, take, prefix: str) -> DataFrame:
    return df.join(table.select(*keys, *[F.col(c).alias(f"{prefix}{c}") for c in take]), list(keys), "left")


def version_deltas(base: DataFrame, versions: DataFrame, progression: DataFrame, shifts: DataFrame, count_change: DataFrame) -> DataFrame:
    """One row per work package and version. Completion never falls; dates move while a package is
    less than 95 % done, in proportion to the version's delay; task counts vary around version 0."""
    v = versions.select(E, "version", "code", "effective_from", "effective_to", "is_active", "delay_days")
    # what a work package's unit decides is looked up before its versions multiply the rows
    base = fallback(base, count_change.withColumn("field", F.lit("x")), "x", ["p25_ratio", "median_ratio", "p75_ratio"], chain=(("SBU", ("sbu",)), ("GLOBAL", ())), count=None, prefix="__r_")
    rows = base.join(v, E)
    key = [E, S, "version"]
    later = F.col("version") > 0
    span = F.datediff("dt_end", "dt_start")
    timing = F.when(span > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.datediff("effective_from", "dt_start") / span))).otherwise(0.5)
    pos = F.col("seq") / F.greatest("n_sows", F.lit(1))
    rows = rows.withColumns({"progress": buckets.progress(timing), "position": buckets.position(pos, 5), "position4": buckets.position(pos, 4)})
    q = ["p25_complete", "median_complete", "p75_complete"]
    rows = _lookup_by(rows, progression.filter("level = 'SBU'"), ["sbu", "progress", "position"], q, "__s_")
    rows = _lookup_by(rows, progression.filter("level = 'GLOBAL'"), ["progress", "position"], q, "__g_")
    lo, mid, hi = [F.coalesce(F.col(f"__s_{c}"), F.col(f"__g_{c}")) for c in q]
    drawn = draws.triangular(draws.uniform(key, "completion"), F.greatest(lo, F.lit(0.0)), mid, F.least(hi, F.lit(100.0)))
    upto = W.partitionBy(E, S).orderBy("version").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("__p", F.when(later, F.coalesce(drawn, F.lit(0.0))).otherwise(0.0))
    rows = rows.withColumn("pct_complete", F.least(F.lit(100.0), F.max("__p").over(upto)))
    rows = rows.withColumn("completion", buckets.completion("pct_complete"))
    take = ["p25_finish_shift", "median_finish_shift", "p75_finish_shift", "median_start_shift"]
    rows = _lookup_by(rows, shifts.withColumnRenamed("position", "position4"), ["completion", "position4"], take, "__m_")
    scale = F.greatest(F.lit(0.2), F.least(F.lit(3.0), F.col("delay_days") / values.MEDIAN_DELAY_DAYS))
    move = later & (F.col("pct_complete") < 95)
    fin = draws.triangular(draws.uniform(key, "shift"), "__m_p25_finish_shift", "__m_median_finish_shift", "__m_p75_finish_shift").cast("int")
    rows = rows.withColumns(
        {
            "__df": F.when(move, F.coalesce((fin * scale).cast("int"), F.lit(0))).otherwise(0),
            "__ds": F.when(move, F.coalesce((F.col("__m_median_start_shift") * scale).cast("int"), F.lit(0))).otherwise(0),
            "__least": min_days(),
        }
    )
    r = draws.from_bounds(key, "ratio", {"p25": F.col("__r_p25_ratio"), "median": F.col("__r_median_ratio"), "p75": F.col("__r_p75_ratio")})
    r = F.least(F.lit(2.0), F.greatest(F.lit(0.5), F.coalesce(r, F.lit(1.0))))
    rows = rows.withColumn("n_tasks", F.when(later, F.greatest(F.lit(5), (F.col("n_tasks_base") * r).cast("int"))).otherwise(F.col("n_tasks_base")))
    drop = [c for c in rows.columns if c.startswith(("__s_", "__g_", "__m_", "__r_", "__p"))]
    rows = rows.drop(*drop, "progress", "position", "position4", "completion")
    return _moved(rows)


def _moved(rows: DataFrame) -> DataFrame:
    """Carry the dates from version to version. The minimum duration makes the next finish depend on the last one:
    f_v = max(f_{v-1} + df_v, s_v + least), where version 0 moves nothing. With D the running sum of df that is
    f_v = D_v + max(f_0, running maximum of s_v + least - D_v), so no version is folded over the ones before."""
    cols = [c for c in rows.columns if c not in (E, S, "version")]
    upto = W.partitionBy(E, S).orderBy("version").rowsBetween(W.unboundedPreceding, W.currentRow)
    moves = ~F.coalesce(F.col("version") == 0, F.lit(False))
    rows = rows.withColumns(
        {
            "__f0": F.unix_date(F.first("sow_finish").over(upto)),
            "__s": F.date_add(F.first("sow_start").over(upto), F.sum("__ds").over(upto).cast("int")),
            "__d": F.sum(F.when(moves, F.col("__df")).otherwise(0)).over(upto).cast("int"),
        }
    )
    least = F.max(F.when(moves, F.unix_date("__s") + F.col("__least") - F.col("__d"))).over(upto)
    finish = F.when(F.col("__f0").isNotNull(), F.date_from_unix_date(F.greatest("__f0", least) + F.col("__d")))
    keep = [c for c in cols if c not in ("sow_start", "sow_finish", "sow_days") and not c.startswith("__")]
    out = rows.select(E, S, "version", *keep, F.col("__s").alias("sow_start"), finish.alias("sow_finish"))
    return out.withColumn("sow_days", F.datediff("sow_finish", "sow_start"))


def cap_drift(df: DataFrame, end: str = "boundary", keys=(E, S, "version"), pull: int = 30) -> DataFrame:
    """No finish later than the boundary plus the package's p90 overrun (180 days where unknown)."""
    p90 = F.coalesce(_overrun(3), F.lit(values.DRIFT_CAP_DEFAULT_DAYS))
    top = F.date_add(end, (p90 * draws.uniform(list(keys), "drift", 1.0, 1.15)).cast("int"))
    df = df.withColumn("__top", top)
    over = F.col("sow_finish") > F.col("__top")
    start = F.when(over & (F.col("sow_start") >= F.col("__top")), F.date_sub("__top", pull)).otherwise(F.col("sow_start"))
    df = df.withColumns({"sow_start": start, "sow_finish": F.when(over, F.col("__top")).otherwise(F.col("sow_finish"))})
    return df.withColumn("sow_days", F.datediff("sow_finish", "sow_start")).drop("__top")


def needed(entities: DataFrame) -> DataFrame:
    """The columns that decide work packages; the others would ride along through every step."""
    names = (E, "sbu", "size_category", "contract_bucket", "asset", "dt_start", "dt_end", "dt_tco", "dt_next_tco")
    return entities.select(*[c for c in names if c in entities.columns])


def generate(entities, versions, profile, constraints, frequency, pairs, progression, shifts, count_change, avg_days=None) -> DataFrame:
    """Work-package rows of every entity and version."""
    base = baseline(needed(entities), profile, constraints, frequency, pairs)
    rows = cap_drift(version_deltas(base, versions, progression, shifts, count_change))
    rows = task_record(repair_dates(rows), [E, S, "version"], avg_days)
    return rows.select(
        E, "code", S, "version", "effective_from", "effective_to", "is_active", "seq", "n_sows", "pct_complete", "n_total", "n_completed", "n_active",
        "n_not_started", "n_early_start", "avg_duration_days", "sow_start", "sow_finish", "sow_days", "avg_n_predecessors", "avg_n_successors", "pct_critical_path",
    )


def self_check(rows: DataFrame) -> DataFrame:
    """Reversed windows, short durations, count identity: one row."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("sow_finish") < F.col("sow_start")).alias("n_reversed"),
        F.count_if(F.col("effective_to") < F.col("effective_from")).alias("n_bad_window"), F.count_if(F.col("sow_days") < min_days()).alias("n_short"),
        F.count_if(F.col("n_total") != F.col("n_completed") + F.col("n_active") + F.col("n_not_started")).alias("n_bad_counts"),
    )
