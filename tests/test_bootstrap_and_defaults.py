"""Bootstrap interval against a plain one; what generators do where a profile knows nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.plans import fidelity as fi
from sigloom.plans import gen_budget, gen_work


def plain_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))


@pytest.mark.parametrize("parts", [1, 7])
def test_bootstrap_interval_is_like_a_plain_one(spark, parts):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 300)
    scores = np.round(labels * 0.8 + rng.normal(size=300), 1)
    df = spark.createDataFrame([(float(s), int(y)) for s, y in zip(scores, labels, strict=True)], "s double, y int").repartition(4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = fi.bootstrap_auc(df, "s", "y", replicates=600).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    plain = [plain_auc(scores[i], labels[i]) for i in (rng.integers(0, 300, 300) for _ in range(600))]
    assert got["auc"] == pytest.approx(plain_auc(scores, labels)) and got["n_replicates"] == 600
    assert got["ci_low"] == pytest.approx(np.quantile(plain, 0.025), abs=0.02)
    assert got["ci_high"] == pytest.approx(np.quantile(plain, 0.975), abs=0.02)


def test_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(400).selectExpr("id % 37 * 1.0 AS s", "cast(id % 37 + id % 11 > 20 as int) AS y")
    made = []
    for parts in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        made.append(fi.bootstrap_auc(df.repartition(parts), "s", "y", replicates=50).first())
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert made[0]["ci_low"] == pytest.approx(made[1]["ci_low"]) and made[0]["ci_high"] == pytest.approx(made[1]["ci_high"])


def test_codes_of_both_sides(spark):
    a = spark.createDataFrame([(1, " Beta "), (2, None), (3, "alpha")], "id int, c string")
    b = spark.createDataFrame([(4, "gamma"), (5, "BETA")], "id int, c string")
    got = {r["id"]: r["code"] for f in fi.encode([a, b], "c", "code") for r in f.collect()}
    assert got == {1: 1, 2: 3, 3: 0, 4: 2, 5: 1}


def test_labels_without_bounds_have_their_place(spark):
    labels = ["(1) Foundation", "Below Grade", "Punch List", "Close Out", "Buys", "Steel", "Precon and Finishes"]
    rows = spark.createDataFrame([("e", "u", s) for s in labels], "entity_id string, sbu string, sow string")
    place = {r["sow"]: r["p"] for r in rows.select("sow", gen_work.label_position().alias("p")).collect()}
    assert place == dict(zip(labels, [6, 6, 18, 18, 3, 10, 18], strict=True))
    none = spark.createDataFrame([], "level string, sbu string, sow string, field string, bounds_json string")
    seq = {r["sow"]: r["seq"] for r in gen_work.arrange(rows, none).collect()}
    assert seq["Buys"] == 1 and {seq["(1) Foundation"], seq["Below Grade"]} == {2, 3} and seq["Steel"] == 4


def test_divisions_without_codes_keep_a_line(spark):
    entities = spark.sql("SELECT 'e' AS entity_id, 'u' AS sbu, 's' AS size_category, 'c' AS contract_bucket, 'a' AS asset, 100D AS amt_contract, DATE'2020-01-01' AS dt_start, DATE'2021-01-01' AS dt_end")
    presence = spark.createDataFrame([("GLOBAL", None, "01", 1.0), ("GLOBAL", None, "02", 1.0)], "level string, sbu string, division string, presence_prob double")
    counts = spark.createDataFrame([], "level string, sbu string, division string, p25 double, p75 double, p99 double")
    frequency = spark.createDataFrame([("02", "x", 3)], "division string, cost_code string, n_projects long")
    mix = spark.createDataFrame([], "division string, category string, weight double")
    ratios = spark.createDataFrame([], "level string, sbu string, asset string, contract_bucket string, division string, category string, n_projects long, p10 double, median double, p90 double, p99 double")
    totals = spark.createDataFrame([], "level string, sbu string, p90 double")
    got = gen_budget.lines(entities, presence, counts, frequency, mix, ratios, totals).select("division", "cost_code", F.col("amt_original") > 0).collect()
    assert {tuple(r) for r in got} == {("01", "GENERAL", True), ("02", "x", True)}
