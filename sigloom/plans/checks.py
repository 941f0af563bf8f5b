"""Rule checks of generated tables, one result row per check, and the scorecard.

Tables by name: project, schedule, rebaseline, task, event, budget; an absent table is None and
its checks are left out. HARD allows no violation, SOFT 5 %, INFO always passes.

Checks don't have plans of their own. Each says which measures of an entity it needs (`PARTS`) and how its result follows from
all entities' measures. The measures that the wanted checks need are gathered in one aggregate per entity for each table, behind
one window where rows are compared in order (of the budget, the widest table, in an aggregate of its own, so that it carries few columns)
and one join for each other table that rows are held against; the tables' entities are
stacked and added up to a card per entity, and one aggregate over the cards gives all results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom.functions import values
from sigloom.operators import joins
from sigloom.operators.ordered import ordered
from sigloom.operators.setops import union_all

HARD, SOFT, INFO = "HARD", "SOFT", "INFO"
SOFT_LIMIT = 0.05
Tables = Mapping[str, DataFrame | None]


@dataclass(frozen=True)
class Rule:
    """A check of single rows: which rows it applies to and what violates it."""

    check_id: str
    layer: str
    category: str
    severity: str
    table: str
    applies: Callable[[], Column]
    violates: Callable[[], Column]

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.table,)


@dataclass(frozen=True)
class Check:
    """A check of cards: the measures it needs, and its result as aggregates over the cards of all entities."""

    check_id: str
    layer: str
    category: str
    severity: str
    needs: tuple[str, ...]
    parts: tuple[str, ...]
    total: Callable[[], Column]
    violations: Callable[[], Column]
    #: severity where it depends on the number of cards
    graded: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Apart:
    """A check whose rows belong to no entity or have an order of their own: one row (total, violations)."""

    check_id: str
    layer: str
    category: str
    severity: str
    needs: tuple[str, ...]
    plan: Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Part:
    """A measure of an entity in one table, and the steps that bring the columns it reads."""

    table: str
    measure: Callable[[], Column]
    steps: tuple[str, ...] = ()


def _every() -> Column:
    return F.lit(True)


def _is_baseline() -> Column:
    return F.col("code").endswith("-BL")


def _pct_complete() -> Column:
    return F.when(F.col("n_total") > 0, F.col("n_completed") / F.col("n_total")).otherwise(0.0)


# steps: columns that rows get before they are aggregated

#: table -> keys, order, value whose falls are counted; what else is read of a chained row, where the table has it
CHAINS = {
    "schedule": (["entity_id"], ["effective_from", "code"], lambda: F.col("dt_tco"), ["effective_to"]),
    "task": (["entity_id", "sow"], ["effective_from", "code"], _pct_complete, []),
    "budget": (["entity_id", "division", "cost_code"], ["dt_budget"], lambda: F.col("amt_jtd"), []),
}


def _chain(df: DataFrame, t: Tables, table: str, narrow: bool = False) -> DataFrame:
    keys, order, value, also = CHAINS[table]
    df = df.withColumn("__x", value())
    if narrow:  # a long chain is written and dealt by slices: only with the columns that its measures read
        df = df.select(*dict.fromkeys([*keys, *order, *[c for c in also if c in df.columns]]), "__x")
    return ordered(df, keys, order, row_number="__rn", lag={"__before": "__x"}, lead={"__next": order[0]})


def _spans(df: DataFrame, t: Tables, table: str) -> DataFrame:
    dates = t["project"].groupBy("entity_id").agg(F.min(F.struct("dt_start", "dt_end")).alias("__p"))
    return df.join(dates, "entity_id", "left")


def _versions(df: DataFrame, t: Tables, table: str) -> DataFrame:
    # a code names one version; were there several, each would count
    by_code = t["schedule"].groupBy("code").agg(F.collect_list(F.struct("dt_tco")).alias("__versions"))
    return df.join(by_code, "code", "left")


def _active(df: DataFrame, t: Tables, table: str) -> DataFrame:
    last = t["schedule"].filter("is_active").groupBy("entity_id").agg(F.collect_list(F.struct("dt_tco")).alias("__active"))
    return df.join(last, "entity_id", "left")


#: the table whose chain has an aggregate of its own beside other measures
WIDEST = "budget"
STEPS: Mapping[str, Callable[..., DataFrame]] = {"versions": _versions, "active": _active, "spans": _spans, "chain": _chain}


def _falls(eps: float = 0.0) -> Callable[[], Column]:
    return lambda: F.count_if(F.col("__before").isNotNull() & (F.col("__x") < F.col("__before") - eps if eps else F.col("__x") < F.col("__before")))


def _follows() -> Column:
    """Rows that have a predecessor."""
    return F.count_if(F.col("__rn") > 1)


def _task_out(buffer: int = 90) -> Column:
    early = F.col("sow_start") < F.date_sub("__p.dt_start", buffer)
    late = F.filter("__versions", lambda v: F.coalesce(early | (F.col("sow_finish") > F.date_add(v["dt_tco"], buffer)), F.lit(False)))
    return F.sum(F.when(F.col("__p").isNotNull(), F.coalesce(F.size(late), F.lit(0))))


def _event_out(buffer: int = 30) -> Column:
    return F.count_if((F.col("created") < F.date_sub("__p.dt_start", buffer)) | (F.col("created") > F.date_add("__p.dt_end", buffer)))


def _times() -> Column:
    """How many active versions a budget row of a known project is held against, at least one."""
    counted = F.col("__p").isNotNull() & F.col("dt_budget").isNotNull()
    return F.when(counted, F.coalesce(F.size("__active"), F.lit(1)))


def _budget_out(buffer: int = 90) -> Column:
    early = F.col("dt_budget") < F.date_sub("__p.dt_start", buffer)
    late = F.coalesce(F.size(F.filter("__active", lambda v: F.coalesce(F.col("dt_budget") > F.date_add(v["dt_tco"], buffer), F.lit(False)))), F.lit(0))
    return F.sum(F.when(early, _times()).otherwise(F.when(_times().isNotNull(), late)))


PARTS: dict[str, Part] = {
    **{f"{name}_n": Part(name, lambda: F.count(F.lit(1))) for name in ("project", "schedule", "rebaseline", "task", "event", "budget")},
    "project_amount": Part("project", lambda: F.max("amt_contract")),
    **{f"project_unit_{i}": Part("project", lambda u=u: F.count_if(F.lower(F.trim("sbu")) == u)) for i, u in enumerate(values.BUSINESS_UNITS)},
    "schedule_active": Part("schedule", lambda: F.count_if("is_active")),
    "schedule_baseline": Part("schedule", lambda: F.count_if(_is_baseline())),
    "schedule_overlaps": Part("schedule", lambda: F.count_if(F.col("__next").isNotNull() & (F.col("effective_to") > F.col("__next"))), ("chain",)),
    "schedule_falls": Part("schedule", _falls(), ("chain",)),
    "schedule_follows": Part("schedule", _follows, ("chain",)),
    "task_orphans": Part("task", lambda: F.count_if(F.col("__versions").isNull()), ("versions",)),
    "task_out": Part("task", _task_out, ("versions", "spans")),
    "task_falls": Part("task", _falls(0.01), ("chain",)),
    "task_follows": Part("task", _follows, ("chain",)),
    "task_codes": Part("task", lambda: F.count_distinct("code")),
    "task_active": Part("task", lambda: F.count_if("is_active")),
    "task_active_codes": Part("task", lambda: F.count_distinct(F.when(F.col("is_active"), F.col("code")))),
    "task_active_sows": Part("task", lambda: F.count_distinct(F.when(F.col("is_active"), F.col("sow")))),
    "event_out": Part("event", _event_out, ("spans",)),
    "event_closed": Part("event", lambda: F.count_if(F.col("status") == "closed")),
    "budget_times": Part("budget", lambda: F.sum(_times()), ("active", "spans")),
    "budget_out": Part("budget", _budget_out, ("active", "spans")),
    "budget_falls": Part("budget", _falls(0.01), ("chain",)),
    "budget_follows": Part("budget", _follows, ("chain",)),
}


def cards(t: Tables, parts: Mapping[str, Part]) -> DataFrame:
    """One row per entity with the wanted measures, 0 where a table doesn't know it; `project_amount` stays NULL there."""
    groups: dict[tuple[str, bool], dict[str, Part]] = {}
    for name, part in parts.items():
        groups.setdefault((part.table, part.table == WIDEST and "chain" in part.steps), {})[name] = part
    for table in {t for t, chained in groups if chained}:
        # a mere number of rows is counted along the chain
        if set(groups.get((table, False), {})) == {f"{table}_n"}:
            groups[table, True] |= groups.pop((table, False))
    frames = []
    for (table, _), wanted in groups.items():
        df = t[table]
        bare = all(p.steps == ("chain",) or n == f"{table}_n" for n, p in wanted.items())
        for step, add in STEPS.items():
            if any(step in p.steps for p in wanted.values()):
                df = add(df, t, table, bare) if step == "chain" else add(df, t, table)
        frames.append(df.groupBy("entity_id").agg(*[p.measure().alias(n) for n, p in wanted.items()]))
    out = union_all(frames).groupBy("entity_id").agg(*[F.max(n).alias(n) for n in parts])
    return out.na.fill(0, [n for n in parts if n != "project_amount"])


# results over the cards


def _sum(c) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _sums(name: str) -> Callable[[], Column]:
    return lambda: _sum(name)


def _on(name: str) -> Column:
    return F.col(name) > 0


def _in_project() -> Column:
    """A NULL key belongs to no project."""
    return F.col("entity_id").isNotNull() & _on("project_n")


def _orphans(child: str) -> dict:
    return {"parts": (f"{child}_n", "project_n"), "total": _sums(f"{child}_n"), "violations": lambda: _sum(F.when(~_in_project(), F.col(f"{child}_n")))}


def _transitions(table: str, found: str) -> dict:
    return {"parts": (f"{table}_follows", found), "total": lambda: F.greatest(F.lit(1), _sum(f"{table}_follows")), "violations": _sums(found)}


def _reconciled(a: Callable[[], Column], b: Callable[[], Column], in_a: Callable[[], Column], in_b: Callable[[], Column]) -> dict:
    """Entities of two tables and those whose counts differ; NULL keys of the two sides don't meet."""
    null = lambda: F.col("entity_id").isNull()
    number = lambda c: F.when(c, 1).otherwise(0)
    return {
        "total": lambda: _sum(F.when(null(), number(in_a()) + number(in_b())).otherwise(number(in_a() | in_b()))),
        "violations": lambda: _sum(F.when(null(), number(in_a() & (a() != 0)) + number(in_b() & (b() != 0))).otherwise(number((in_a() | in_b()) & (a() != b())))),
    }


def _in_range(mean: Callable[[], Column], low: float, high: float) -> dict:
    return {"total": lambda: F.lit(1), "violations": lambda: F.when(mean().between(low, high), 0).otherwise(1)}


def _per_million() -> Column:
    return F.try_divide(F.col("event_n").cast("double"), F.col("project_amount") / 1e6)


def _sized() -> Column:
    return _in_project() & _on("event_n")


def _chain_parents(t: Tables) -> DataFrame:
    # ids and the parents that rows name, counted under one key
    own, named = F.struct(F.col("event_id").alias("key"), F.lit(0).alias("child")), F.struct(F.col("parent_id").alias("key"), F.lit(1).alias("child"))
    per_key = t["event"].select(F.inline(F.array(own, named))).filter("key IS NOT NULL").groupBy("key").agg(F.sum("child").alias("n"), F.min("child").alias("orphan"))
    return per_key.agg(_sum("n").alias("total"), _sum(F.when(F.col("orphan") == 1, F.col("n"))).alias("violations"))


def _near_flag(t: Tables, limit: int = 60) -> DataFrame:
    flagged = t["event"].filter("is_near")
    days = joins.daily_counts(flagged, "entity_id", F.col("created"))
    anchors = joins.daily_counts(t["schedule"].filter(~_is_baseline()), "entity_id", F.col("effective_from"))
    dist = joins.nearest_distance(days, anchors, "entity_id").join(days, ["entity_id", "day"])
    far = F.col("min_days").isNull() | (F.col("min_days") > limit)
    # flagged events without a day are counted, and near to nothing that could be far
    undated = flagged.filter("created IS NULL").agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(False).alias("far"))
    dated = dist.select("n", far.alias("far"))
    return dated.unionByName(undated).agg(_sum("n").alias("total"), _sum(F.when(F.col("far"), F.col("n"))).alias("violations"))


def _divisions(t: Tables) -> DataFrame:
    return t["budget"].agg(F.count_distinct("division").alias("total"), F.lit(0).cast("long").alias("violations"))


def _known_units() -> Column:
    return sum((F.when(_sum(f"project_unit_{i}") == 0, 1).otherwise(0) for i in range(len(values.BUSINESS_UNITS))), F.lit(0))


REF, TEMP, DOM, CROSS, CARD = "Referential", "Temporal", "Domain", "Cross-Table", "Cardinality"


def _c(name: str) -> Column:
    return F.col(name)


def _known(*names: str) -> Callable[[], Column]:
    def cond() -> Column:
        out = F.lit(True)
        for n in names:
            out = out & F.col(n).isNotNull()
        return out

    return cond


CHECKS: tuple[Rule | Check | Apart, ...] = (
    Check("REF_SCHED_TO_PROJECT", "L1", REF, HARD, ("schedule", "project"), **_orphans("schedule")),
    Check("REF_TASK_TO_PROJECT", "L1", REF, HARD, ("task", "project"), **_orphans("task")),
    Check("REF_TASK_TO_SCHEDULE", "L1", REF, HARD, ("task", "schedule"), ("task_n", "task_orphans"), _sums("task_n"), _sums("task_orphans")),
    Check("REF_RFI_TO_PROJECT", "L1", REF, HARD, ("event", "project"), **_orphans("event")),
    Apart("REF_RFI_CHAIN_PARENT", "L1", REF, HARD, ("event",), _chain_parents),
    Check("REF_BUDGET_TO_PROJECT", "L1", REF, HARD, ("budget", "project"), **_orphans("budget")),
    Check("REF_REBASELINE_TO_PROJECT", "L1", REF, HARD, ("rebaseline", "project"), **_orphans("rebaseline")),
    Check("TEMP_SCHED_ONE_ACTIVE", "L1", TEMP, HARD, ("schedule", "project"), ("project_n", "schedule_active"), _sums("project_n"), lambda: F.count_if(_on("project_n") & (F.col("entity_id").isNull() | (F.col("schedule_active") != 1)))),
    Check("TEMP_SCD2_NO_OVERLAP", "L1", TEMP, HARD, ("schedule",), ("schedule_n", "schedule_overlaps"), _sums("schedule_n"), _sums("schedule_overlaps")),
    Check("TEMP_TCO_MONOTONIC", "L1", TEMP, HARD, ("schedule",), **_transitions("schedule", "schedule_falls")),
    Rule("TEMP_NTP_BEFORE_TCO", "L1", TEMP, HARD, "schedule", _every, lambda: _c("dt_ntp") > _c("dt_tco")),
    Check("TEMP_SOW_IN_PROJECT_RANGE", "L1", TEMP, SOFT, ("task", "schedule", "project"), ("task_n", "task_out"), _sums("task_n"), _sums("task_out")),
    Rule("TEMP_BASELINE_ZERO_COMPLETION", "L1", TEMP, HARD, "task", _is_baseline, lambda: _c("n_completed") > 0),
    Check("TEMP_COMPLETION_PROGRESSION", "L1", TEMP, SOFT, ("task",), **_transitions("task", "task_falls")),
    Check("TEMP_RFI_IN_PROJECT_RANGE", "L1", TEMP, HARD, ("event", "project"), ("event_n", "event_out"), _sums("event_n"), _sums("event_out")),
    Rule("TEMP_RFI_DUE_AFTER_CREATED", "L1", TEMP, HARD, "event", _every, lambda: _c("due") < _c("created")),
    Rule("TEMP_RFI_RESOLVED_AFTER_CREATED", "L1", TEMP, HARD, "event", _known("resolved"), lambda: _c("resolved") < _c("created")),
    Check("TEMP_BUDGET_IN_PROJECT_RANGE", "L1", TEMP, SOFT, ("budget", "project", "schedule"), ("budget_times", "budget_out"), _sums("budget_times"), _sums("budget_out")),
    Check("TEMP_BUDGET_JTD_MONOTONIC", "L1", TEMP, HARD, ("budget",), **_transitions("budget", "budget_falls")),
    Rule("DOMAIN_RFI_STATUS_RESOLVED", "L2", DOM, HARD, "event", lambda: _c("status").isin("open", "overdue", "draft"), lambda: _c("resolved").isNotNull()),
    Rule("DOMAIN_RFI_CLOSED_HAS_RESOLVED", "L2", DOM, HARD, "event", lambda: _c("status") == "closed", lambda: _c("resolved").isNull()),
    Rule("DOMAIN_BUDGET_FTC_NONNEG", "L2", DOM, HARD, "budget", _every, lambda: _c("amt_ftc") < -0.01),
    Rule(
        "DOMAIN_BUDGET_ECAC_IDENTITY", "L2", DOM, SOFT, "budget", _known("amt_ecac", "amt_projected"),
        lambda: F.abs(_c("amt_ecac") - (_c("amt_projected") + _c("amt_ftc"))) > F.greatest(F.abs("amt_ecac") * 0.01, F.lit(1000.0)),
    ),
    Rule(
        "DOMAIN_BUDGET_REVISED_CALC", "L2", DOM, SOFT, "budget", _known("amt_original", "amt_revised"),
        lambda: F.abs(_c("amt_revised") - (_c("amt_original") + _c("amt_in") + _c("amt_out"))) > F.greatest(F.abs("amt_revised") * 0.01, F.lit(100.0)),
    ),
    Check("DOMAIN_TASK_ONE_ACTIVE_VERSION", "L2", DOM, HARD, ("task", "project"), ("project_n", "task_active", "task_active_codes"), _sums("project_n"), lambda: F.count_if(_on("task_active") & (F.col("task_active_codes") != 1))),
    Rule("DOMAIN_TASK_COUNT_IDENTITY", "L2", DOM, HARD, "task", _every, lambda: _c("n_total") != _c("n_completed") + _c("n_active") + _c("n_not_started")),
    Rule("DOMAIN_TASK_PCT_RANGE", "L2", DOM, HARD, "task", _every, lambda: (_pct_complete() < -0.001) | (_pct_complete() > 1.001)),
    Check("DOMAIN_SCHED_HAS_BASELINE", "L2", DOM, HARD, ("schedule", "project"), ("project_n", "schedule_baseline"), _sums("project_n"), lambda: F.greatest(_sum("project_n") - F.count_if(_on("schedule_baseline") & F.col("entity_id").isNotNull()), F.lit(0))),
    Rule("DOMAIN_PROJ_DATE_ORDER", "L2", DOM, HARD, "project", _every, lambda: _c("dt_end") < _c("dt_start")),
    Rule("DOMAIN_PROJ_POSITIVE_AMOUNTS", "L2", DOM, HARD, "project", _every, lambda: (_c("amt_contract") <= 0) | (_c("gross_area") <= 0)),
    Rule("DOMAIN_RFI_VALID_TIMING", "L2", DOM, HARD, "event", _every, lambda: ~_c("timing").isin(*values.TIMING_LABELS)),
    Rule("DOMAIN_RFI_VALID_TRADE", "L2", DOM, HARD, "event", _every, lambda: ~F.trim(_c("trade")).isin(*values.TRADES)),
    Apart("CROSS_RFI_REBASELINE_FLAG", "L2", CROSS, SOFT, ("event", "rebaseline", "schedule"), _near_flag),
    Check(
        "CROSS_SCHED_RB_COUNT_MATCH", "L2", CROSS, HARD, ("schedule", "rebaseline"), ("schedule_n", "rebaseline_n"),
        **_reconciled(lambda: F.greatest(_c("schedule_n") - 1, F.lit(0)), lambda: _c("rebaseline_n"), lambda: _on("schedule_n"), lambda: _on("rebaseline_n")),
    ),
    Check(
        "CROSS_RFI_SIZE_SCALING", "L2", CROSS, SOFT, ("event", "project"), ("event_n", "project_n", "project_amount"), lambda: F.count_if(_sized()),
        lambda: F.count_if(_sized() & ~_per_million().between(1.0, 100.0)), lambda: F.when(F.count_if(_sized()) >= 10, SOFT).otherwise(INFO),
    ),
    Check(
        "CROSS_TASK_SCHED_VERSION_MATCH", "L2", CROSS, HARD, ("task", "schedule"), ("task_n", "task_codes", "schedule_n"),
        **_reconciled(lambda: _c("task_codes"), lambda: _c("schedule_n"), lambda: _on("task_n"), lambda: _on("schedule_n")),
    ),
    Check("CROSS_BUDGET_PROJECT_COVERAGE", "L2", CROSS, INFO, ("budget", "project"), ("project_n", "budget_n"), _sums("project_n"), lambda: _sum("project_n") - F.count_if(_on("budget_n") & F.col("entity_id").isNotNull())),
    Check("CARD_ALL_SBUS_PRESENT", "L2", CARD, INFO, ("project",), tuple(f"project_unit_{i}" for i in range(len(values.BUSINESS_UNITS))), lambda: F.lit(len(values.BUSINESS_UNITS)), _known_units),
    Check("CARD_SCHED_AVG_VERSIONS", "L2", CARD, SOFT, ("schedule", "project"), ("schedule_n", "project_n"), **_in_range(lambda: F.try_divide(_sum("schedule_n"), _sum("project_n")), 1.5, 4.0)),
    Check("CARD_TASK_AVG_SOWS", "L2", CARD, SOFT, ("task",), ("task_active", "task_active_sows"), **_in_range(lambda: F.avg(F.when(_on("task_active"), _c("task_active_sows"))), 15, 30)),
    Check(
        "CARD_RFI_STATUS_DIST", "L2", CARD, SOFT, ("event",), ("event_n", "event_closed"), **_in_range(lambda: F.try_divide(_sum("event_closed"), _sum("event_n")) * 100, 50, 95),
        graded=lambda: F.when(F.count_if(_on("event_n")) >= 10, SOFT).otherwise(INFO),
    ),
    Apart("CARD_BUDGET_DIVISIONS", "L2", CARD, INFO, ("budget",), _divisions),
)
BY_ID = {c.check_id: c for c in CHECKS}
RESULT = ("check_id", "layer", "category", "severity", "total_checked", "violations", "violation_pct", "passed")


def _graded(df: DataFrame) -> DataFrame:
    rate = F.when(F.col("total") > 0, F.col("violations") / F.col("total")).otherwise(0.0)
    passed = F.when(F.col("severity") == HARD, F.col("violations") == 0).when(F.col("severity") == SOFT, rate <= SOFT_LIMIT).otherwise(True)
    return df.select(
        "check_id", "layer", "category", "severity", F.col("total").cast("long").alias("total_checked"),
        F.col("violations").cast("long").alias("violations"), F.round(rate * 100, 3).alias("violation_pct"), passed.alias("passed"),
    )


def rule_parts(rule: Rule) -> dict[str, Part]:
    """How many rows of an entity a rule applies to, and how many of them violate it."""
    return {
        f"{rule.check_id}:n": Part(rule.table, lambda: F.count_if(rule.applies())),
        f"{rule.check_id}:bad": Part(rule.table, lambda: F.count_if(rule.applies() & rule.violates())),
    }


def fused(tables: Tables, wanted: list[Rule | Check]) -> DataFrame:
    """Results of rules and checks from one set of cards."""
    parts: dict[str, Part] = {}
    results = []
    for c in wanted:
        own = rule_parts(c) if isinstance(c, Rule) else {n: PARTS[n] for n in c.parts}
        parts |= own
        total, bad = ((_sum(f"`{n}`")) for n in own) if isinstance(c, Rule) else (c.total(), c.violations())
        severity = c.graded() if isinstance(c, Check) and c.graded else F.lit(c.severity)
        row = {"check_id": F.lit(c.check_id), "layer": F.lit(c.layer), "category": F.lit(c.category), "severity": severity, "total": total.cast("long"), "violations": bad.cast("long")}
        results.append(F.struct(*[v.alias(n) for n, v in row.items()]))
    return cards(tables, parts).agg(F.array(*results).alias("r")).select(F.inline("r"))


def run(tables: Tables, ids: Iterable[str] | None = None) -> DataFrame:
    """Result rows of the checks whose tables are all present."""
    wanted = [BY_ID[i] for i in ids] if ids is not None else list(CHECKS)
    ready = [c for c in wanted if all(tables.get(n) is not None for n in c.needs)]
    together = [c for c in ready if not isinstance(c, Apart)]
    parts = [fused(tables, together)] if together else []
    for c in ready:
        if isinstance(c, Apart):
            labels = {"check_id": c.check_id, "layer": c.layer, "category": c.category, "severity": c.severity}
            parts.append(c.plan(tables).select(*[F.lit(v).alias(n) for n, v in labels.items()], F.col("total").cast("long").alias("total"), F.col("violations").cast("long").alias("violations")))
    return _graded(union_all(parts))


def scorecard(results: DataFrame) -> DataFrame:
    """Totals overall, by severity and by category, as a table."""
    cols = [
        F.count(F.lit(1)).alias("n_checks"), F.count_if("passed").alias("n_passed"),
        F.count_if(~F.col("passed") & (F.col("severity") != INFO)).alias("n_failed"),
    ]
    sets = results.groupingSets([[], ["severity"], ["category"]], "severity", "category").agg(F.grouping_id().alias("__g"), *cols)
    scope = F.when(F.col("__g") == 3, "overall").when(F.col("__g") == 1, "severity").otherwise("category")
    return sets.select(scope.alias("scope"), F.coalesce("severity", "category", F.lit("all")).alias("name"), "n_checks", "n_passed", "n_failed")
