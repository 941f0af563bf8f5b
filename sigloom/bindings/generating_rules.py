"""What must hold of the generated rows: counts that the given tables fix, and violations, of which there are none."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sigloom.bindings import fidelity as bf
from sigloom.bindings import generating as g
from sigloom.bindings.registry import query
from sigloom.bindings.views import with_
from sigloom.functions import draws
from sigloom.plans import fidelity as fi
from sigloom.plans import gen_budget, gen_entities, gen_events, gen_versions, gen_work

PROJECTS = "(SELECT count(*) FROM project WHERE dt_end > dt_start)"


def none_of(*names: str) -> str:
    return ", ".join(f"CAST(0 AS BIGINT) AS {n}" for n in names)


def entities_and(*names: str) -> str:
    return with_("project", body=f"SELECT {PROJECTS} AS n_entities, {none_of(*names)}")


def per_entity(df, **broken):
    """Entities with rows, and rows that break a rule."""
    counts = [F.count_if(F.coalesce(F.expr(c) if isinstance(c, str) else c, F.lit(False))).alias(n) for n, c in broken.items()]
    return df.agg(F.count_distinct("entity_id").alias("n_entities"), *counts)


@query("G3_beta_range", with_("event", body="SELECT trade, count(*) AS n, CAST(0 AS BIGINT) AS n_outside FROM event GROUP BY 1"))
def _(v):
    e = v.event.select("event_id", "trade").join(g.lifecycle(v), "trade")
    x = draws.beta(["event_id"], "lifecycle", "p10", "p25", "median", "p75", "p90")
    e = e.withColumn("x", x)
    return e.groupBy("trade").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").isNull() | (F.col("x") < F.col("p10")) | (F.col("x") > F.col("p90") * 1.1 + 1e-9)).alias("n_outside"))


@query("G9_copula_range", with_("entity", body="SELECT count(DISTINCT sbu) AS n_groups, CAST(0 AS BIGINT) AS n_short, CAST(0 AS BIGINT) AS n_outside FROM entity WHERE dt_end >= dt_start"))
def _(v):
    """Each group has twice its quota of rows, within the range of the real ones."""
    real = g.real(v)
    edges = real.agg(*[f(c).alias(f"{n}_{c}") for c in ("gross_area", "amt_contract") for n, f in (("lo", F.min), ("hi", F.max))])
    rows = gen_entities.sample_entities(real, g.synthetic_size(v), fields=("gross_area", "amt_contract"))
    per = rows.groupBy("sbu").agg(F.count(F.lit(1)).alias("n"), F.max("quota").alias("quota"), *[f(c).alias(f"{n}{c}") for c in ("gross_area", "amt_contract") for n, f in (("a_", F.min), ("z_", F.max))])
    edge = edges.select(F.struct("*")).scalar()
    out = per.withColumn("e", edge)
    bad = (F.col("a_gross_area") < F.col("e.lo_gross_area")) | (F.col("z_gross_area") > F.col("e.hi_gross_area")) | (F.col("a_amt_contract") < F.col("e.lo_amt_contract")) | (F.col("z_amt_contract") > F.col("e.hi_amt_contract"))
    return out.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("n") != 2 * F.col("quota")).alias("n_short"), F.count_if(bad).alias("n_outside"))


@query("G9_root_table_rules", f"SELECT count(*) AS n_rows, {none_of('n_repeated', 'n_broken')} FROM customer")
def _(v):
    out = gen_entities.generate(g.real(v), g.synthetic_size(v))
    broken = (F.col("dt_end") < F.col("dt_start")) | (F.col("gross_area") <= 0) | (F.col("n_floors") < 1) | (F.col("amt_contract") <= 0)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), (F.count(F.lit(1)) - F.count_distinct("entity_id")).alias("n_repeated"), F.count_if(F.coalesce(broken, F.lit(True))).alias("n_broken"))


@query("G10_field_chain_rules", with_("entity", body=f"SELECT count(*) AS n_rows, {none_of('n_floors_missing', 'n_bad_amount')} FROM entity WHERE dt_end >= dt_start"))
def _(v):
    r = g.real(v)
    out = gen_entities.field_chain(r.select("entity_id", "sbu", "n_floors", "gross_area"), gen_entities.field_stats(r), ["entity_id"])
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("n_floors").isNull() | (F.col("n_floors") < 1)).alias("n_floors_missing"),
        F.count_if(F.col("amt_contract").isNull() | F.col("amt_cost").isNull() | (F.col("amt_contract") <= 0) | (F.col("amt_cost") <= 0)).alias("n_bad_amount"),
    )


@query("G13_version_rules", entities_and("n_missing", "n_reversed", "n_falling", "n_not_one_active"))
def _(v):
    checked = gen_versions.self_check(g.stored_versions(v), ["entity_id", "code", "dt_tco", "effective_from", "effective_to"])
    return checked.select("n_entities", "n_missing", "n_reversed", "n_falling", "n_not_one_active")


@query("G15_offset_rules", entities_and("n_below_floor"))
def _(v):
    """A close-out is 14 days after its target at least, less 6 % of jitter."""
    out = gen_versions.with_offsets(g.entities(v), g.version_profile(v))
    return per_entity(out, n_below_floor="co_offset IS NULL OR co_offset < 13")


@query("G17_order_rules", entities_and("n_gaps", "n_repeated"))
def _(v):
    rows = g.chosen(v).withColumn("copies", F.count(F.lit(1)).over(W.partitionBy("entity_id", "sow"))).withColumn("last", F.max("seq").over(W.partitionBy("entity_id")))
    return per_entity(rows, n_gaps="last <> n_sows OR seq NOT BETWEEN 1 AND n_sows", n_repeated="copies > 1")


def placed_in_chain(v):
    t = g.work_tables(v)
    return gen_work.place(gen_work.overlaps(gen_work.durations(g.chosen(v).withColumn("boundary", F.col("dt_end")), t["constraints"]), t["pairs"]))


@query("G18_chain_rules", entities_and("n_first_elsewhere", "n_bad_length", "n_too_late"))
def _(v):
    return per_entity(
        placed_in_chain(v), n_first_elsewhere="seq = 1 AND sow_start <> dt_start", n_bad_length="datediff(sow_finish, sow_start) <> sow_days OR sow_days NOT BETWEEN 30 AND 1000",
        n_too_late="seq > 1 AND sow_start > date_add(boundary, 60)",
    )


@query("G20_clip_rules", entities_and("n_past_boundary", "n_bad_length"))
def _(v):
    """None of the bound labels may overrun, so all are clipped."""
    rows = gen_work.overrun_or_clip(gen_work.scale_to_boundary(placed_in_chain(v)))
    return per_entity(rows, n_past_boundary="sow_finish > boundary", n_bad_length="datediff(sow_finish, sow_start) <> sow_days")


@query("G23_delta_rules", entities_and("n_falls", "n_bad_base", "n_bad_length"))
def _(v):
    w = W.partitionBy("entity_id", "sow").orderBy("version")
    rows = g.deltas(v).withColumn("before", F.lag("pct_complete").over(w))
    return per_entity(rows, n_falls="pct_complete < before", n_bad_base="version = 0 AND pct_complete <> 0", n_bad_length="datediff(sow_finish, sow_start) <> sow_days OR n_tasks < 1")


@query("G25_record_rules", entities_and("n_bad_counts", "n_repeated", "n_done_at_start"))
def _(v):
    rows = g.task_records(v).withColumn("copies", F.count(F.lit(1)).over(W.partitionBy("entity_id", "sow", "version")))
    return per_entity(rows, n_bad_counts="n_total <> n_completed + n_active + n_not_started", n_repeated="copies > 1", n_done_at_start="version = 0 AND n_completed > 0")


@query("G27_event_rules", entities_and("n_outside", "n_bad_status", "n_bad_order"))
def _(v):
    e = v.stored("generated_events", lambda: g.generated_events(v)).withColumn("last", F.max("seq").over(W.partitionBy("entity_id"))).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("entity_id")))
    return per_entity(e, n_outside="created < dt_start OR created > dt_end", n_bad_status="(status = 'closed') <> (resolved IS NOT NULL)", n_bad_order="due < created OR resolved < created OR n <> last")


@query("G30_count_rules", with_("event_project", body="SELECT count(*) AS n_entities, CAST(0 AS BIGINT) AS n_without FROM event_project"))
def _(v):
    anchors = v.event.filter("trade = 'error'").select("entity_id").distinct()
    return per_entity(gen_events.event_count(g.event_entities(v), g.event_constraints(v), anchors), n_without="n_events IS NULL OR n_events < 1")


@query("G32_follow_up_rules", with_("project", body=f"SELECT {none_of('n_orphans', 'n_bad_parent', 'n_bad_gap', 'n_known_id')}"))
def _(v):
    e = v.stored("generated_events", lambda: g.generated_events(v))
    f = gen_events.follow_ups(e)
    parents = e.select(F.col("event_id").alias("parent_id"), F.col("created").alias("asked"), F.col("status").alias("was"))
    known = e.select("event_id", F.lit(True).alias("known"))
    rows = f.select("event_id", "parent_id", "created").join(parents, "parent_id", "left").join(known, "event_id", "left")
    return per_entity(
        rows.withColumn("entity_id", F.lit(0)), n_orphans="asked IS NULL", n_bad_parent="was NOT IN ('closed', 'overdue')", n_bad_gap="datediff(created, asked) NOT BETWEEN 7 AND 21", n_known_id="known"
    ).drop("n_entities")


@query("G38_line_rules", entities_and("n_not_positive", "n_without_mandatory"))
def _(v):
    rows = gen_budget.lines(g.entities(v), **g.budget_tables(v), mandatory=g.pl.MANDATORY)
    per = rows.groupBy("entity_id").agg(F.count_if(F.col("amt_original") <= 0).alias("low"), F.count_distinct(F.when(F.col("division").isin(*g.pl.MANDATORY), F.col("division"))).alias("must"))
    return per_entity(per, n_not_positive="low > 0", n_without_mandatory=f"must < {len(g.pl.MANDATORY)}")


@query("G41_work_rules", with_("project", body=f"SELECT {none_of('n_reversed', 'n_bad_window', 'n_short', 'n_bad_counts')}"))
def _(v):
    return gen_work.self_check(g.task_records(v)).drop("n_rows")


@query("F7_fold_sizes", f"SELECT CAST(floor({draws.uniform_sql(['doc_id'], 'fold')} * 5) AS INTEGER) AS fold, quality, count(*) AS n FROM labels GROUP BY 1, 2")
def _(v):
    return fi.folds(v.table("labels", "doc_id", "quality"), "doc_id", "quality", 5).groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n"))


@query("F10_bootstrap_rules", "WITH " + bf.SC + " SELECT auc, true AS is_around, CAST(1000 AS BIGINT) AS n_replicates FROM (" + bf.auc_sql("", "sc") + ")")
def _(v):
    d = v.table("documents", "doc_id", "n_chars").join(v.table("labels", "doc_id", "quality"), "doc_id")
    ci = fi.bootstrap_auc(d, "n_chars", "quality")
    return ci.select(F.round("auc", 8).alias("auc"), F.col("auc").between(F.col("ci_low"), F.col("ci_high")).alias("is_around"), F.col("n_replicates").cast("long").alias("n_replicates"))
