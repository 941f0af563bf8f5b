"""Helpers of several operators: sized blocks, connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.session import cut_lineage

BLOCK_BYTES = 6 << 20
NO_ID = 2**63 - 1


def block_count(docs: DataFrame, text: str = "text", size: int = BLOCK_BYTES) -> int:
    """How many blocks of about `size` bytes of text the table makes; reads the text's length only."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(1, -(-int(total) // size))


def block_of(key: str, blocks: int) -> Column:
    """An even and repeatable number from 0 to blocks - 1."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (id, root), root the smallest id; ids without an edge are left out.

    Alternating stars: each round hangs the larger neighbours of a node on its smallest one, then the smaller ones.
    Neighbourhoods are never gathered: their minimum is aggregated and joined back, and a node with very many edges
    is split by the adaptive skew join. Every round is cut by a checkpoint in the shared folder.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now = cut_lineage(now)
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = cut_lineage(small.filter("u <> v").distinct())
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_003).alias("h")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(roots)


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it; a cluster has it installed or gets it by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
