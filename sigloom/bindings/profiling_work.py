"""Work-package profile on the line items of each customer."""

from pyspark.sql import functions as F

from sigloom.bindings.aggregating import json_of, q_list, rounded
from sigloom.bindings.profiling_versions import level_rows
from sigloom.bindings.registry import query
from sigloom.bindings.views import bucket_sql, with_
from sigloom.functions import values
from sigloom.plans import work

FULL = ("p1", "p5", "p10", "p25", "median", "p75", "p90", "p95", "p99")
SHORT = ("p5", "p10", "p25", "median", "p75", "p90", "p95")
FIVE = ("p10", "p25", "median", "p75", "p90")
THREE = ("p25", "median", "p75")
MIN_TASKS = 20  # customers have about 40 tasks each


def ms(x, *more):
    names = {"mean": f"round(avg({x}), 6) AS mean", "stddev": f"round(stddev_samp({x}), 6) AS stddev", "min": f"min({x}) AS min", "max": f"max({x}) AS max"}
    return ", ".join(names[m] for m in more)


WORK = """
cov AS (SELECT entity_id, count(*) AS total_tasks, count(sow) AS tasks_with_label, count(DISTINCT sow) AS n_labels, round(count(sow) * CAST(100 AS DOUBLE) / count(*), 2) AS pct_coverage FROM task GROUP BY 1
 HAVING round(count(sow) * CAST(100 AS DOUBLE) / count(*), 2) >= 75 AND count(*) >= 20 AND count(DISTINCT sow) >= 5),
t AS (SELECT task.*, p.sbu, p.size_category, p.contract_bucket, p.dt_start, p.dt_end FROM task JOIN cov USING (entity_id) JOIN project p USING (entity_id) WHERE sow IS NOT NULL),
w0 AS (SELECT entity_id, sow, sbu, size_category, contract_bucket, min(task_start) AS sow_start, max(task_end) AS sow_finish FROM t GROUP BY ALL),
w AS (SELECT *, date_diff('day', sow_start, sow_finish) AS sow_days, row_number() OVER (PARTITION BY entity_id ORDER BY sow_start, sow) AS seq FROM w0)"""


def covered(v):
    return work.covered_entities(v.task, min_tasks=MIN_TASKS)


def entities(v):
    return v.project_table.select("entity_id", "sbu", "size_category", "contract_bucket", "dt_start", "dt_end")


def tasks(v):
    """Tasks of the well-labelled customers."""
    return work.labelled(v.task).join(covered(v).select("entity_id"), "entity_id", "left_semi")


def windows(v):
    return work.windows(tasks(v), "entity_id", "sow", "task_start", "task_end").join(entities(v).drop("dt_start", "dt_end"), "entity_id")


def seq(v):
    return work.sequence(windows(v))


@query("D32_label_coverage", with_("task", "project", extra=WORK, body="SELECT * FROM cov"))
def _(v):
    return covered(v)


LV = [("SBU", ("sbu",), 5), ("SBU_SIZE", ("sbu", "size_category"), 5), ("SBU_CONTRACT", ("sbu", "contract_bucket"), 5)]
ED = ("sbu", "size_category", "contract_bucket")


SOW_COUNT_SQL = level_rows(LV, f"count(*) AS n_projects, {q_list('n_sows', FULL)}, {ms('n_sows', 'min', 'max', 'mean', 'stddev')}", "(SELECT entity_id, sbu, size_category, contract_bucket, count(*) AS n_sows FROM w GROUP BY ALL)", dims=ED)


def sow_count_profile(v):
    return rounded(work.sow_count_profile(work.sow_counts(tasks(v)).join(entities(v), "entity_id")))


@query("D33_sow_counts", with_("task", "project", extra=WORK, body=SOW_COUNT_SQL))
def _(v):
    return sow_count_profile(v)


@query("D34_sow_windows", with_("task", "project", extra=WORK, body="SELECT entity_id, sow, sow_start, sow_finish, sow_days, seq FROM w"))
def _(v):
    return seq(v).select("entity_id", "sow", "sow_start", "sow_finish", "sow_days", "seq")


SEQ_COLS = f"count(*) AS n_occurrences, count(DISTINCT entity_id) AS n_projects, {q_list('seq', FIVE)}, {ms('seq', 'mean', 'stddev', 'min', 'max')}"
SEQ_SQL = f"""SELECT 'SOW_SBU' AS level, sow, sbu, {SEQ_COLS} FROM w GROUP BY sow, sbu HAVING count(DISTINCT entity_id) >= 5
UNION ALL SELECT 'GLOBAL', sow, NULL, {SEQ_COLS} FROM w GROUP BY sow HAVING count(DISTINCT entity_id) >= 10"""


@query("D35_sequence_positions", with_("task", "project", extra=WORK, body=SEQ_SQL))
def _(v):
    return rounded(work.sequence_profile(seq(v)))


@query("D36_sow_frequency", with_("task", "project", extra=WORK, body="""
SELECT sbu, sow, count(DISTINCT entity_id) AS n_projects, count(*) AS n_occurrences, (SELECT count(DISTINCT entity_id) FROM w x WHERE x.sbu = w.sbu) AS n_total,
 round(count(DISTINCT entity_id) * CAST(100 AS DOUBLE) / (SELECT count(DISTINCT entity_id) FROM w x WHERE x.sbu = w.sbu), 2) AS pct_projects FROM w GROUP BY 1, 2"""))
def _(v):
    return work.sow_frequency(seq(v))


SOW_LV = [("SOW_TYPE", ("sow",), 10), ("SOW_SBU", ("sow", "sbu"), 5)]
TASK_COUNT_SQL = level_rows(SOW_LV, f"count(*) AS n_observations, {q_list('n_tasks', SHORT)}, {ms('n_tasks', 'mean', 'min', 'max')}", "(SELECT entity_id, sow, sbu, count(DISTINCT task_code) AS n_tasks FROM t GROUP BY ALL)", dims=("sow", "sbu"))


def task_counts(v):
    return rounded(work.task_count_profile(tasks(v).join(entities(v).select("entity_id", "sbu"), "entity_id")))


@query("D37_task_counts", with_("task", "project", extra=WORK, body=TASK_COUNT_SQL))
def _(v):
    return task_counts(v)


DUR_SQL = level_rows(SOW_LV, f"count(*) AS n_observations, {q_list('sow_days', SHORT)}, {ms('sow_days', 'mean', 'min', 'max')}", "w", dims=("sow", "sbu"))


@query("D38_sow_durations", with_("task", "project", extra=WORK, body=DUR_SQL))
def _(v):
    return rounded(work.duration_profile(windows(v)))


PAIRS = WORK + """,
cp AS (SELECT entity_id, sow AS sow_first, nxt AS sow_second, date_diff('day', ns, sow_finish) AS overlap_days, CASE WHEN sow_days > 0 THEN round(date_diff('day', ns, sow_finish) / CAST(sow_days AS DOUBLE) * 100, 2) END AS overlap_pct
 FROM (SELECT *, lead(sow) OVER x AS nxt, lead(sow_start) OVER x AS ns FROM w WINDOW x AS (PARTITION BY entity_id ORDER BY seq)) WHERE nxt IS NOT NULL)"""
OV = ", ".join(f"quantile_disc(overlap_{k}, {p}) AS {n}_{k}" for k in ("days", "pct") for n, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)))
OV = f"count(*) AS n_transitions, {OV}, round(avg(overlap_days), 6) AS mean_days, round(avg(overlap_pct), 6) AS mean_pct"


@query("D39_overlaps", with_("task", "project", extra=PAIRS, body=f"""
SELECT 'GENERAL' AS level, NULL AS sow_first, NULL AS sow_second, 'all_pairs' AS sow_pair, {OV} FROM cp
UNION ALL SELECT 'PAIR', sow_first, sow_second, sow_first || ' → ' || sow_second, {OV} FROM cp GROUP BY sow_first, sow_second HAVING count(*) >= 5"""))
def _(v):
    return rounded(work.overlap_profile(work.consecutive(seq(v))))


CONC = WORK + """,
sp AS (SELECT entity_id, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS d FROM (SELECT entity_id, min(sow_start) lo, max(sow_finish) hi FROM w GROUP BY 1)),
act AS (SELECT sp.entity_id, sp.d, count(w.sow) AS n FROM sp LEFT JOIN w ON w.entity_id = sp.entity_id AND sp.d BETWEEN w.sow_start AND w.sow_finish GROUP BY 1, 2),
pc AS (SELECT a.*, p.sbu, p.size_category FROM (SELECT entity_id, max(n) AS mx, avg(n) AS av FROM act GROUP BY 1) a JOIN project p USING (entity_id))"""


def qx(x, suffix):
    probs = (("p10", 0.1), ("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p90", 0.9))
    return ", ".join(f"round(quantile_disc({x}, {p}), 6) AS {n}_{suffix}" for n, p in probs) + f", round(avg({x}), 6) AS mean_{suffix}, round(stddev_samp({x}), 6) AS stddev_{suffix}"


def concurrency(v):
    per = work.concurrency(seq(v)).join(entities(v).select("entity_id", "sbu", "size_category"), "entity_id")
    return rounded(work.concurrency_profile(per))


@query("D40_concurrency", with_("task", "project", extra=CONC, body=level_rows([("SBU", ("sbu",), 5), ("SBU_SIZE", ("sbu", "size_category"), 5)], f"count(*) AS n_projects, {qx('mx', 'max')}, {qx('av', 'avg')}", "pc", dims=("sbu", "size_category"))))
def _(v):
    return concurrency(v)


TD_SQL = f"SELECT sow, count(*) AS n_tasks, {q_list('d', FIVE)}, {ms('d', 'mean')} FROM (SELECT sow, date_diff('day', task_start, task_end) AS d FROM t) WHERE d >= 0 GROUP BY 1 HAVING count(*) >= 100"


@query("D41_task_durations", with_("task", "project", extra=WORK, body=TD_SQL))
def _(v):
    return rounded(work.task_duration_profile(tasks(v)))


OFF = WORK + """,
off AS (SELECT t.sow, date_diff('day', w.sow_start, t.task_start) / CAST(w.sow_days AS DOUBLE) AS o, date_diff('day', t.task_start, t.task_end) AS d FROM t JOIN w USING (entity_id, sow) WHERE w.sow_days > 0
 AND date_diff('day', w.sow_start, t.task_start) / CAST(w.sow_days AS DOUBLE) BETWEEN 0 AND 1)"""


@query("D42_task_start_shape", with_("task", "project", extra=OFF, body=f"""
SELECT sow, count(*) AS n_observations, {', '.join(f'round(quantile_disc(o, {p}), 6) AS {n}' for n, p in zip(FIVE, (0.1, 0.25, 0.5, 0.75, 0.9)))}, {ms('o', 'mean', 'stddev')} FROM off GROUP BY 1 HAVING count(*) >= 100"""))
def _(v):
    return rounded(work.start_shape_profile(work.task_offsets(tasks(v), windows(v))))


@query("D43_duration_by_position", with_("task", "project", extra=OFF, body=f"""
SELECT sow, {bucket_sql('o', values.POSITION3_EDGES, values.POSITION3_LABELS)} AS position, count(*) AS n_tasks, {q_list('d', FIVE)}, {ms('d', 'mean', 'min', 'max')} FROM off WHERE d >= 0 GROUP BY 1, 2 HAVING count(*) >= 50"""))
def _(v):
    return rounded(work.duration_by_position(work.task_offsets(tasks(v), windows(v))))


@query("D44_completion_distribution", with_("task", "project", extra=WORK, body="""
SELECT sow, round(count(*) FILTER (WHERE s = 'c') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_completed, round(count(*) FILTER (WHERE s = 'a') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_active,
 round(count(*) FILTER (WHERE s = 'n') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_not_started FROM (SELECT sow, CASE WHEN remaining = 0 THEN 'c' WHEN remaining = target THEN 'n' WHEN remaining > 0 AND remaining < target THEN 'a' END AS s FROM t) GROUP BY 1"""))
def _(v):
    return work.completion_distribution(tasks(v), digits=4)


@query("D45_early_start_rate", with_("task", "project", extra=WORK, body="""
SELECT sow, count(*) AS n_tasks, count(*) FILTER (WHERE start_source = 'early start') AS n_early_start, round(count(*) FILTER (WHERE start_source = 'early start') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_early_start FROM t GROUP BY 1 HAVING count(*) >= 100"""))
def _(v):
    return work.early_start_rate(tasks(v), digits=4)


SNAP = WORK + """,
sn AS (SELECT entity_id, sow, effective_from, count(*) AS n_tasks, count(*) FILTER (WHERE remaining = 0) AS n_completed, min(task_start) AS sow_start, max(task_end) AS sow_finish,
 round(count(*) FILTER (WHERE remaining = 0) * CAST(100 AS DOUBLE) / count(*), 2) AS pct_complete FROM t GROUP BY 1, 2, 3),
pj AS (SELECT entity_id, sbu, dt_start, date_diff('day', dt_start, dt_end) AS span FROM project WHERE date_diff('day', dt_start, dt_end) > 30)"""


def snaps(v):
    return work.snapshots(tasks(v))


PLACED = f"""
pl AS (SELECT *, {bucket_sql('timing', values.PROGRESS_EDGES, values.PROGRESS_LABELS)} AS progress, {bucket_sql('pos', values.POSITION5_EDGES, values.POSITION5_LABELS)} AS position FROM (
 SELECT sn.*, pj.sbu, round(date_diff('day', dt_start, effective_from) / CAST(span AS DOUBLE), 3) AS timing, round(date_diff('day', dt_start, sow_start) / CAST(span AS DOUBLE), 3) AS pos FROM sn JOIN pj USING (entity_id))
 WHERE timing BETWEEN 0 AND 1.2 AND pos BETWEEN 0 AND 1.2)"""
CPL = "count(*) AS n_observations, round(avg(pct_complete), 2) AS avg_pct_complete, quantile_disc(pct_complete, 0.25) AS p25_complete, quantile_disc(pct_complete, 0.5) AS median_complete, quantile_disc(pct_complete, 0.75) AS p75_complete"


@query("D46_completion_progression", with_("task", "project", extra=SNAP + "," + PLACED, body=level_rows([("SBU", ("sbu",), 5), ("GLOBAL", (), 10)], CPL, "pl", ("progress", "position"), ("sbu",))))
def _(v):
    return work.completion_progression(snaps(v), entities(v))


RAT = """
rt AS (SELECT r.*, p.sbu FROM (SELECT entity_id, round(nx / CAST(n_tasks AS DOUBLE), 3) AS ratio FROM (SELECT *, lead(n_tasks) OVER (PARTITION BY entity_id, sow ORDER BY effective_from) AS nx FROM sn) WHERE nx IS NOT NULL AND n_tasks >= 2) r
 JOIN project p USING (entity_id) WHERE ratio BETWEEN 0.2 AND 5)"""
RQ = ", ".join(f"quantile_disc(ratio, {p}) AS {n}_ratio" for n, p in zip(FIVE, (0.1, 0.25, 0.5, 0.75, 0.9)))


@query("D47_task_count_change", with_("task", "project", extra=SNAP + "," + RAT, body=level_rows([("SBU", ("sbu",), 5), ("GLOBAL", (), 0)], f"count(*) AS n_transitions, round(avg(ratio), 6) AS avg_ratio, {RQ}", "rt", (), ("sbu",))))
def _(v):
    return work.count_change_profile(snaps(v), entities(v), min_base=2, digits=6)


SHIFT = f"""
sh AS (SELECT *, {bucket_sql('pct_complete', values.COMPLETION_EDGES, values.COMPLETION_LABELS)} AS completion, {bucket_sql('pos', values.POSITION4_EDGES, values.POSITION4_LABELS)} AS position FROM (
 SELECT s1.pct_complete, date_diff('day', s1.sow_finish, s2.sow_finish) AS finish_shift, date_diff('day', s1.sow_start, s2.sow_start) AS start_shift,
  date_diff('day', s2.sow_start, s2.sow_finish) - date_diff('day', s1.sow_start, s1.sow_finish) AS duration_change, round(date_diff('day', pj.dt_start, s1.sow_start) / CAST(pj.span AS DOUBLE), 3) AS pos
 FROM sn s1 JOIN sn s2 ON s1.entity_id = s2.entity_id AND s1.sow = s2.sow AND s2.effective_from > s1.effective_from JOIN pj ON pj.entity_id = s1.entity_id
 WHERE NOT EXISTS (SELECT 1 FROM sn s3 WHERE s3.entity_id = s1.entity_id AND s3.sow = s1.sow AND s3.effective_from > s1.effective_from AND s3.effective_from < s2.effective_from)))"""
SH = ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in ("finish_shift", "start_shift", "duration_change"))
SH += ", " + ", ".join(f"quantile_disc(finish_shift, {p}) AS {n}_finish_shift" for n, p in zip(THREE, (0.25, 0.5, 0.75)))
SH += ", quantile_disc(start_shift, 0.5) AS median_start_shift, quantile_disc(duration_change, 0.5) AS median_duration_change"


@query("D48_date_shifts", with_("task", "project", extra=SNAP + "," + SHIFT, body=f"SELECT completion, position, count(*) AS n_observations, {SH} FROM sh GROUP BY 1, 2 HAVING count(*) >= 10"))
def _(v):
    return work.date_shift_profile(snaps(v), entities(v), digits=6)


@query("D49_work_tables", with_("task", "project", extra=WORK, body=f"""
SELECT 'profile' AS tab, level, sbu, size_category, contract_bucket, NULL AS sow, 'n_sows_per_project' AS field, n_projects AS n, NULL AS bounds_json FROM ({SOW_COUNT_SQL})
UNION ALL SELECT 'profile', level, sbu, NULL, NULL, sow, 'n_tasks', n_observations, NULL FROM ({TASK_COUNT_SQL})
UNION ALL SELECT 'profile', 'SOW_TYPE', NULL, NULL, NULL, sow, 'avg_task_duration', n_tasks, NULL FROM ({TD_SQL})
UNION ALL SELECT 'constraint', level, sbu, NULL, NULL, sow, 'sow_duration_days', n_observations, {json_of([(c, c) for c in ('p25', 'median', 'p75', 'p95')])} FROM ({DUR_SQL})
UNION ALL SELECT 'constraint', level, sbu, NULL, NULL, sow, 'sequence_position', n_projects, {json_of([(c, c) for c in ('mean', 'stddev', 'min', 'max')])} FROM ({SEQ_SQL})"""))
def _(v):
    prof = work.profile_table(
        {"n_sows_per_project": sow_count_profile(v), "n_tasks": task_counts(v), "avg_task_duration": rounded(work.task_duration_profile(tasks(v)))}
    )
    cons = work.constraint_table(
        {
            "sow_duration_days": (rounded(work.duration_profile(windows(v))), ["p25", "median", "p75", "p95"]),
            "sequence_position": (rounded(work.sequence_profile(seq(v))).drop("n_occurrences"), ["mean", "stddev", "min", "max"]),
        }
    )
    keys = ["level", "sbu", "size_category", "contract_bucket", "sow", "field"]
    return prof.select(F.lit("profile").alias("tab"), *keys, F.col("n_projects").alias("n"), F.lit(None).cast("string").alias("bounds_json")).unionByName(
        cons.select(F.lit("constraint").alias("tab"), *keys, "n", "bounds_json")
    )
