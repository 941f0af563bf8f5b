from datetime import date

import pytest
from pyspark.sql import functions as F

from sigloom.functions import buckets, clean


def one(spark, col, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, v)
    return df.select(col.alias("o")).first()["o"]


@pytest.mark.parametrize(
    "x, left, last, right",
    [
        (None, None, "XLarge", None), (0.0, "Small", "Small", None), (49_999.0, "Small", "Small", "Small"), (50_000.0, "Medium", "Medium", "Small"),
        (100_000.0, "Large", "Large", "Medium"), (200_000.0, "XLarge", "XLarge", "Large"), (200_001.0, "XLarge", "XLarge", "XLarge"),
    ],
)
def test_size_edges(spark, x, left, last, right):
    v = F.lit(x).cast("double")
    assert one(spark, buckets.size("x"), x=v) == left
    assert one(spark, buckets.size("x", null_to_last=True), x=v) == last
    assert one(spark, buckets.right_closed("x", (50e3, 100e3, 200e3), ("Small", "Medium", "Large", "XLarge")), x=v) == right


@pytest.mark.parametrize("d, want", [(6, "minimal"), (7, "small"), (30, "moderate"), (60, "major"), (120, "large"), (179, "large"), (180, "severe")])
def test_severity_edges(spark, d, want):
    assert one(spark, buckets.severity("d"), d=F.lit(d)) == want


def test_reversed_dates(spark):
    rows = [(date(2020, 2, 29), date(2020, 1, 1)), (date(2020, 1, 1), date(2020, 1, 1)), (None, date(2020, 1, 1)), (date(2020, 1, 1), None)]
    df = spark.createDataFrame(rows, "s date, e date").select(clean.repair_end("s", "e").alias("e"))
    assert [r["e"] for r in df.collect()] == [date(2020, 2, 29), date(2020, 1, 1), date(2020, 1, 1), None]


@pytest.mark.parametrize("den, want", [(0.0, None), (-1.0, None), (None, None), (4.0, 0.5)])
def test_guarded_ratio(spark, den, want):
    assert one(spark, clean.ratio("n", "d"), n=F.lit(2.0), d=F.lit(den).cast("double")) == want


def test_cast_floor_keeps_null_without_default(spark):
    x = F.lit(None).cast("double")
    assert one(spark, clean.cast_floor("x", "double", 1.0), x=x) is None
    assert one(spark, clean.cast_floor("x", "int", 1, default=1), x=x) == 1


def test_keys(spark):
    assert one(spark, clean.readable_key("SYN", "g", "n"), g=F.lit("mission critical"), n=F.lit(7)) == "SYN-MIS-000007"
    assert one(spark, clean.readable_key("SYN", "g", "n"), g=F.lit("--"), n=F.lit(12345678)) == "SYN-GEN-12345678"
    assert one(spark, clean.version_code("e", "v"), e=F.lit("P1"), v=F.lit(0)) == "P1-000.01-BL"
    assert one(spark, clean.version_code("e", "v"), e=F.lit("P1"), v=F.lit(3)) == "P1-003.MO-RB"


def test_index_factor(spark):
    assert one(spark, clean.index_factor("y"), y=F.lit(2024)) == 1.0
    assert one(spark, clean.index_factor("y"), y=F.lit(2025)) == pytest.approx(1476 / 1426)
    assert one(spark, clean.index_factor("y"), y=F.lit(2027)) == pytest.approx(1476 * 1.04**2 / 1426)
    assert one(spark, clean.index_factor("y"), y=F.lit(1900)) == 1.0


def test_universe_year_filter_reaches_the_scan(spark, sf):
    df = clean.universe(spark.read.parquet(f"{sf}/orders.parquet"), start="o_orderdate", start_year=1998)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_pad_renames_before_it_fills(spark):
    df = clean.pad(spark.createDataFrame([(3, 1.5)], "n_tasks int, mean double"), {"n_projects": "long", "p5": "double", "mean": "double"}, {"n_tasks": "n_projects"})
    assert df.first().asDict() == {"n_projects": 3, "p5": None, "mean": 1.5}


def test_mix_collapse(spark):
    from sigloom.operators.aggregates import collapsed_mix

    rows = [("d", "a", 19.0, i) for i in range(5)] + [("d", "b", 5.0, 9)] + [("e", "a", 1.0, 1)] + [("f", "a", 1.0, i) for i in range(5)] + [("f", "b", 3.0, i) for i in range(5)]
    df = spark.createDataFrame(rows, "division string, category string, amt double, e int")
    got = {(r["division"], r["category"]): r["weight"] for r in collapsed_mix(df, ["division"], "category", "amt", "e").collect()}
    assert got == {("d", "a"): 1.0, ("e", "other"): 1.0, ("f", "a"): 0.25, ("f", "b"): 0.75}


def test_levels_keep_real_nulls_apart_from_totals(spark):
    from sigloom.operators.levels import Level, profile_levels

    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", None)], "sbu string, asset string")
    got = {(r["level"], r["sbu"], r["asset"]): r["n"] for r in profile_levels(df, [Level("SBU", ("sbu",)), Level("SBU_ASSET", ("sbu", "asset"))]).collect()}
    assert got == {("SBU", "a", None): 3, ("SBU_ASSET", "a", "x"): 1, ("SBU_ASSET", "a", None): 2}
