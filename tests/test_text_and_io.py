import pytest
from pyspark.sql import functions as F

from sigloom.functions import text
from sigloom.sources import tables
from sigloom.streaming.incremental import append_ready

GOOD = '{"str_rfi_subject":"Slab edge at grid B","str_rfi_description":"The slab edge shown on the drawing does not fit the field.","str_rfi_response":"Use detail 4."}'


def test_reply_cleaning(spark):
    replies = [
        (1, f"```json\n[{GOOD},{GOOD}]\n```", 2), (2, GOOD, 1), (3, "[" + GOOD.replace("Slab edge at grid B", "short") + "]", 1), (4, "sorry, no", 1), (5, f"[{GOOD}]", 2), (6, None, 1), (7, f"[{GOOD},{GOOD}]", 1),
    ]
    df = spark.createDataFrame(replies, "id int, raw string, wanted int").withColumns({"t": F.lit("B SHELL"), "s": F.lit("(18) Roofing")})
    out = text.clean_replies(df, ["id"], "raw", "wanted", "t", "s")
    got = {}
    for r in out.orderBy("id", "position").collect():
        got.setdefault(r["id"], []).append(r["is_stub"])
    assert got == {1: [False, False], 2: [False], 3: [True], 4: [True], 5: [False, True], 6: [True], 7: [False]}
    stub = out.filter("is_stub").first()
    assert stub["str_rfi_subject"] == "Clarification required: B SHELL — (18) Roofing"
    assert text.stub_rate(out).first()["n_rows"] == 9


def test_batches_put_small_groups_into_a_catch_all(spark):
    from sigloom.plans.gen_events import text_batches

    rows = [(i, "A", "pre", "x") for i in range(25)] + [(100 + i, "A", "post", "y") for i in range(3)] + [(200, "A", "during", "z")]
    df = spark.createDataFrame(rows, "id int, trade string, zone string, sow string").withColumn("p", F.lit(1))
    got = text_batches(df, ["p"], "id").groupBy("is_catchall", "group_zone", "group_sow", "batch").count().collect()
    assert sorted(tuple(r) for r in got) == [(False, "pre", "x", 1, 20), (False, "pre", "x", 2, 5), (True, "post", "y", 1, 4)]


def test_optional_scan(spark, sf, tmp_path):
    assert tables.optional_scan(spark, f"{sf}/absent.parquet") is None
    assert tables.optional_scan(spark, "no_such_table") is None
    assert tables.optional_scan(spark, f"{sf}/nation.parquet").count() == 25


def test_flush_writes_once_and_resumes(spark, tmp_path):
    where = f"{tmp_path}/out"
    df = spark.range(500).select((F.col("id") % 50).alias("k"), "id")
    tables.flush(df.filter("k < 20"), where, "k", every=60)
    tables.flush(df, where, "k", every=100)
    tables.flush(df, where, "k", every=100)
    out = spark.read.parquet(where)
    assert out.count() == 500 and out.distinct().count() == 500


def test_flush_computes_its_input_once_and_keeps_entities_whole(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(600).selectExpr("id % 60 AS k", "id").mapInArrow(count, "k long, id long")
    n = tables.flush(df, f"{tmp_path}/out", "k", every=100)
    assert 3 <= n <= 6 and made.value == 600
    assert tables.flush(df, f"{tmp_path}/out", "k", every=100) == 0
    assert spark.read.parquet(f"{tmp_path}/out").groupBy("k").count().filter("count <> 10").count() == 0


def test_stream_keeps_entities_of_several_batches(spark, tmp_path):
    src, out, ckpt = (f"{tmp_path}/{n}" for n in ("src", "out", "ckpt"))
    spark.range(10).select(F.col("id").alias("k")).write.parquet(src)
    for _ in range(2):
        q = append_ready(spark.readStream.schema("k long").parquet(src), out, "k", ckpt)
        q.awaitTermination(60)
        spark.range(5, 15).select(F.col("id").alias("k")).write.mode("append").parquet(src)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == sorted([*range(10), *range(5, 15)])


def test_shared_keys_assertion(spark):
    from sigloom.operators.setops import shared_keys

    a, b = spark.range(3).toDF("k"), spark.range(2, 5).toDF("k")
    assert [r["k"] for r in shared_keys(a, b, "k", must_exist=True).collect()] == [2]
    with pytest.raises(Exception, match="no shared k"):
        shared_keys(a, spark.range(9, 11).toDF("k"), "k", must_exist=True).collect()
