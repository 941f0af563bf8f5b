"""The corpus pipeline: quality filter, near-duplicate filter, repeat removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs. All
but the last keep the columns of docs, whatever they are called.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import contamination, packing, quality, repeats, shingle_join
from sigloom.llm.queries import fitted_quality
from sigloom.llm.shared import importable
from sigloom.session import ensure_checkpoint_dir

#: documents below this score are rejected
LEAST_QUALITY = 0.3
#: the network, the MinHash bands and the tokenizer have no SQL form; tests hold the operators against brute-force versions, not the stages' rows
ORACLE_SQL = None


def original(docs: DataFrame, carried: str = "carried") -> list[Column]:
    """The columns of docs out of the struct that carries them."""
    return [F.col(f"{carried}.`{c}`") for c in docs.columns]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network doesn't reject; it is fitted on labelled rows of the whole `documents` table, test rows left out."""
    importable(spark)
    model = fitted_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter(F.col("score") >= LEAST_QUALITY).select(*original(docs))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest doc_id; rows without a doc_id stay."""
    importable(spark)
    classes = shingle_join.links(docs)
    # of rows with one doc_id the first by text stays: a class has one document
    gone = classes.filter("class_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
    return first_of_each(kept)


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row for each doc_id; all rows without one."""
    twice = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    alone = docs.join(twice, docs["doc_id"] == twice["doc_id"], "left_anti")
    every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    many = docs.select(F.col("doc_id").alias("key"), every.alias("carried")).join(twice.withColumnRenamed("doc_id", "key"), "key")
    least = many.groupBy("key").agg(F.min("carried").alias("carried"))
    return alone.unionByName(least.select(*original(docs)))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that one with a smaller doc_id also has; a text without any stays as it is."""
    importable(spark)
    cut = repeats.remove_repeats(docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("original")))
    changed = F.col("n_removed") > 0
    columns = []
    for c in docs.columns:
        old = F.col(f"carried.original.`{c}`")
        if c == "text":
            columns.append(F.when(changed, F.col("kept")).otherwise(old).alias(c))
        elif c == "n_chars":
            columns.append(F.when(changed, F.char_length("kept").cast(docs.schema[c].dataType)).otherwise(old).alias(c))
        else:
            columns.append(old.alias(c))
    return cut.select(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    importable(spark)
    leaks = contamination.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaky = leaks.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    return docs.join(leaky, docs["doc_id"] == leaky["doc_id"], "left_anti")


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 ids."""
    importable(spark)
    return packing.pack(docs, packing.tokenizer_path("byte_bpe_50k.json"), encode_special_tokens=False)


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicate_filter),
    ("repeats", repeat_removal),
    ("decontamination", decontamination),
    ("packing", sequence_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what they hand on lies in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
