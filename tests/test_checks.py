"""One injected violation must show up in exactly one check."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sigloom.plans import checks

D = date


def clean_tables(spark):
    mk = spark.createDataFrame
    project = mk([(f"P{i}", "commercial", D(2020, 1, 1), D(2021, 1, 1), 5e6, 1000.0) for i in range(3)], "entity_id string, sbu string, dt_start date, dt_end date, amt_contract double, gross_area double")
    schedule = mk(
        [
            row
            for i in range(3)
            for row in (
                (f"P{i}", f"P{i}-000.01-BL", D(2019, 10, 1), D(2020, 5, 31), D(2020, 1, 1), D(2021, 1, 1), False),
                (f"P{i}", f"P{i}-001.MO-RB", D(2020, 6, 1), D(2099, 12, 31), D(2020, 1, 1), D(2021, 3, 1), True),
            )
        ],
        "entity_id string, code string, effective_from date, effective_to date, dt_ntp date, dt_tco date, is_active boolean",
    )
    rebaseline = mk([(f"P{i}", D(2020, 6, 1)) for i in range(3)], "entity_id string, occurred date")
    task = mk(
        [
            (f"P{i}", c, f"S{k}", a, e, 10, d, 2, 8 - d, D(2020, 2, 1), D(2020, 8, 1))
            for i in range(3) for k in range(16) for c, a, e, d in ((f"P{i}-000.01-BL", False, D(2019, 10, 1), 0), (f"P{i}-001.MO-RB", True, D(2020, 6, 1), 4))
        ],
        "entity_id string, code string, sow string, is_active boolean, effective_from date, n_total int, n_completed int, n_active int, n_not_started int, sow_start date, sow_finish date",
    )
    event = mk(
        [
            (f"E{i}-{k}", f"P{i}", D(2020, 6, 10), D(2020, 6, 17), D(2020, 6, 20) if k < 8 else None, "closed" if k < 8 else "open", "B SHELL", "During", True, f"E{i}-0" if k == 1 else None)
            for i in range(3) for k in range(10)
        ],
        "event_id string, entity_id string, created date, due date, resolved date, status string, trade string, timing string, is_near boolean, parent_id string",
    )
    budget = mk(
        [(f"P{i}", "03", "c", D(2020, m, 1), 1000.0 * m, 9000.0, 8000.0, 1000.0, 9000.0, 100.0, -50.0, 9050.0) for i in range(3) for m in range(2, 6)],
        "entity_id string, division string, cost_code string, dt_budget date, amt_jtd double, amt_ecac double, amt_projected double, amt_ftc double, amt_original double, amt_in double, amt_out double, amt_revised double",
    )
    return {"project": project, "schedule": schedule, "rebaseline": rebaseline, "task": task, "event": event, "budget": budget}


def failing(tables):
    return {r["check_id"]: r["violations"] for r in checks.run(tables).collect() if r["violations"] > 0 and r["severity"] != "INFO"}


@pytest.fixture(scope="module")
def tables(spark):
    return {k: df.cache() for k, df in clean_tables(spark).items()}


def test_clean_tables_pass(tables):
    assert failing(tables) == {}
    assert checks.run(tables).count() == 42


def change(df, where, **new):
    return df.withColumns({c: F.when(F.expr(where), F.expr(v)).otherwise(F.col(c)) for c, v in new.items()})


MUTATIONS = [
    ("schedule", "code = 'P1-000.01-BL'", {"effective_to": "DATE'2020-06-02'"}, {"TEMP_SCD2_NO_OVERLAP": 1}),
    ("schedule", "code = 'P1-001.MO-RB'", {"is_active": "false"}, {"TEMP_SCHED_ONE_ACTIVE": 1}),
    ("schedule", "code = 'P1-001.MO-RB'", {"dt_tco": "DATE'2020-12-01'"}, {"TEMP_TCO_MONOTONIC": 1}),
    ("event", "event_id = 'E1-3'", {"trade": "'X'"}, {"DOMAIN_RFI_VALID_TRADE": 1}),
    ("event", "event_id = 'E1-3'", {"timing": "'Never'"}, {"DOMAIN_RFI_VALID_TIMING": 1}),
    ("event", "event_id = 'E1-3'", {"due": "DATE'2020-06-09'"}, {"TEMP_RFI_DUE_AFTER_CREATED": 1}),
    ("event", "event_id = 'E1-3'", {"resolved": "CAST(NULL AS DATE)"}, {"DOMAIN_RFI_CLOSED_HAS_RESOLVED": 1}),
    ("event", "event_id = 'E1-9'", {"resolved": "DATE'2020-06-11'"}, {"DOMAIN_RFI_STATUS_RESOLVED": 1}),
    ("event", "event_id = 'E1-1'", {"parent_id": "'gone'"}, {"REF_RFI_CHAIN_PARENT": 1}),
    ("event", "event_id = 'E1-3'", {"entity_id": "'P9'"}, {"REF_RFI_TO_PROJECT": 1, "CROSS_RFI_REBASELINE_FLAG": 1}),
    ("budget", "entity_id = 'P1' AND dt_budget = DATE'2020-04-01'", {"amt_jtd": "2999.98D"}, {"TEMP_BUDGET_JTD_MONOTONIC": 1}),
    ("budget", "entity_id = 'P1' AND dt_budget = DATE'2020-04-01'", {"amt_ftc": "-1D", "amt_ecac": "7999D"}, {"DOMAIN_BUDGET_FTC_NONNEG": 1}),
    ("task", "entity_id = 'P1' AND sow = 'S3' AND is_active", {"n_active": "3"}, {"DOMAIN_TASK_COUNT_IDENTITY": 1}),
    ("task", "entity_id = 'P1' AND sow = 'S3' AND NOT is_active", {"n_completed": "1", "n_not_started": "7"}, {"TEMP_BASELINE_ZERO_COMPLETION": 1}),
    ("project", "entity_id = 'P1'", {"gross_area": "0D"}, {"DOMAIN_PROJ_POSITIVE_AMOUNTS": 1}),
]


@pytest.mark.parametrize("table, where, new, want", MUTATIONS, ids=[next(iter(m[3])) for m in MUTATIONS])
def test_one_mutation_one_failure(tables, table, where, new, want):
    bad = {**tables, table: change(tables[table], where, **new)}
    assert failing(bad) == want


def test_touching_windows_pass_and_zero_active_is_caught(tables):
    touch = change(tables["schedule"], "code = 'P1-000.01-BL'", effective_to="DATE'2020-06-01'")
    assert failing({**tables, "schedule": touch}) == {}


def test_absent_tables_skip_their_checks(tables):
    got = {r["check_id"] for r in checks.run({**tables, "budget": None}).collect()}
    assert not any("BUDGET" in c for c in got) and len(got) == 42 - 8


def test_row_rules_share_one_scan(tables):
    rules = [c for c in checks.CHECKS if isinstance(c, checks.Rule) and c.table == "event"]
    plan = checks.fused({"event": tables["event"]}, rules)._jdf.queryExecution().optimizedPlan().toString()
    # per entity, the stacked cards, all of them
    assert plan.count("Aggregate") == 3 and plan.count("InMemoryRelation") == 1 and len(rules) == 6


def test_all_checks_read_few_times(spark, tables, tmp_path):
    """Each table is read once for its measures, and once for each other order or key that its rows are looked up by."""
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = checks.run(stored)._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = [leaves.apply(i).toString() for i in range(leaves.size())]
    assert len(read) <= 18 and "ScalarSubquery" not in plan.toString()
    assert checks.run(stored).filter("violations > 0 AND severity <> 'INFO'").count() == 0


def test_keys_that_are_null_and_empty_tables(spark, tables):
    lost = {**tables, "task": change(tables["task"], "entity_id = 'P1'", entity_id="CAST(NULL AS STRING)")}
    assert failing(lost)["REF_TASK_TO_PROJECT"] == 32
    empty = {k: df.limit(0) for k, df in tables.items()}
    got = {r["check_id"]: (r["total_checked"], r["violations"]) for r in checks.run(empty).collect()}
    assert len(got) == 42 and got["REF_TASK_TO_PROJECT"] == (0, 0) and got["TEMP_TCO_MONOTONIC"] == (1, 0)


def test_scorecard_totals(tables):
    card = {(r["scope"], r["name"]): (r["n_checks"], r["n_failed"]) for r in checks.scorecard(checks.run(tables)).collect()}
    assert card["overall", "all"] == (42, 0)
    assert sum(n for (s, _), (n, _f) in card.items() if s == "category") == 42
