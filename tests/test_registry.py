"""The driver contract, plan shapes, and the bound queries against their SQL on the smallest data."""

import re

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
PYTHON_ALLOWED = {"G3_beta_draw", "G3_beta_range", "G27_structured_events", "G27_event_rules", "G32_follow_ups", "G32_follow_up_rules"}
SAMPLE = ["P19_lifecycle_share", "J12_event_window_join", "J15_fallback_profile", "A22_collapsed_mix", "A27_quota_allocation", "W14_minimum_gap", "W20_inversions", "D9_scurve_shape", "D39_overlaps", "E10_rebaseline_audit", "T8_monthly_timeline", "F3_ks_statistic", "G34_text_batches", "G8_soft_bounds", "G24_drift_cap", "G35_example_retrieval", "F7_fold_sizes"]


def test_entry_and_names(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["level", "sbu", "asset"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def ids(prefix):
    return {int(m.group(1)) for q in entry.queries() if (m := re.match(rf"{prefix}(\d+)_", q))}


@pytest.mark.parametrize("prefix, n", [("S", 12), ("P", 31), ("J", 19), ("A", 31), ("W", 20), ("O", 7), ("D", 49), ("G", 41), ("E", 13), ("V", 43), ("T", 10), ("F", 12)])
def test_every_operator_is_registered(prefix, n):
    assert ids(prefix) == set(range(1, n + 1))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, sf, duck, name):
    def norm(rows, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        show = lambda v: f"{v:.7g}" if isinstance(v, float) else str(v)
        return sorted(tuple(show(r[i]) for i in order) for r in rows)

    df = entry.queries()[name](spark, sf)
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(cur.fetchall(), cols)


@pytest.mark.parametrize("name", ["D1_entity_profile", "D16_timing_zone_shares", "D40_concurrency", "W1_version_number", "T4_anchor_spike", "V9_TEMP_SCD2_NO_OVERLAP"])
def test_plans_stay_in_the_jvm_and_off_one_partition(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_profile_reads_only_its_columns(spark, sf):
    plan = entry.queries()["D1_entity_profile"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    lineitem = next(x for x in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in x)
    assert len(lineitem.split(",")) == 4
