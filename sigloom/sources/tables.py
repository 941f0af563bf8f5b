"""Sources and sinks. Parquet by default; `fmt="delta"` where the cluster has it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.session import ensure_checkpoint_dir


def scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or a Parquet path when the name has a slash; columns are pruned at the scan."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df.select(*columns) if columns else df


def optional_scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame | None:
    """None when the table does not exist."""
    if "/" in name:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    else:
        exists = spark.catalog.tableExists(name)
    return scan(spark, name, columns) if exists else None


def sql_source(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over the catalog and the named DataFrames (as `{name}` in the text)."""
    return spark.sql(text, **frames)


def _save(writer, name: str) -> None:
    writer.save(name) if "/" in name else writer.saveAsTable(name)


def overwrite(df: DataFrame, name: str, *, fmt: str = "parquet", keep_schema: bool = False, partition_by: Sequence[str] = ()) -> None:
    w = df.write.format(fmt).mode("overwrite")
    if not keep_schema:
        w = w.option("overwriteSchema", "true")
    _save(w.partitionBy(*partition_by) if partition_by else w, name)


def append(df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append; readers merge the schemas (`mergeSchema` on write where the format supports it)."""
    w = df.write.format(fmt).mode("append").option("mergeSchema", "true")
    _save(w.partitionBy(*partition_by) if partition_by else w, name)


def merged_scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_all(frames: Mapping[str, DataFrame], where: Callable[[str], str], **kw) -> None:
    """One write per output table of a run."""
    for name, df in frames.items():
        overwrite(df, where(name), **kw)


def pinned(df: DataFrame) -> DataFrame:
    """Keep a shared base for the profiles built on it; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def constants(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small constant rows only; data never comes from the driver."""
    return spark.createDataFrame(list(rows), schema)


def not_done(todo: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Rows of entities that the output does not hold yet."""
    return todo if done is None else todo.join(done.select(key).distinct(), key, "left_anti")


#: buckets of entities in which a flush is staged: no batch is smaller than one
FLUSH_BUCKETS = 256


def flush(df: DataFrame, name: str, key: str, every: int, spark: SparkSession | None = None, **kw) -> int:
    """Append entities in batches of about `every` rows, skipping the ones already written; returns the number of batches.

    The input is computed once and staged in the shared folder by buckets of entities; a batch is a run of buckets, read from
    their files alone. Each batch is one append job; a run that dies is resumed by calling it again.
    """
    spark = spark or df.sparkSession
    todo = not_done(df, optional_scan(spark, name), key)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flush-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(FLUSH_BUCKETS)).cast("int")
    todo.withColumn("__bucket", bucket).repartition("__bucket").write.partitionBy("__bucket").parquet(folder)
    staged = spark.read.schema(todo.select("*", bucket.alias("__bucket")).schema).parquet(folder)
    batches: list[tuple[int, int]] = []
    first = rows = 0
    for r in staged.groupBy("__bucket").count().orderBy("__bucket").collect():
        rows += r["count"]
        if rows >= every:
            batches.append((first, r["__bucket"]))
            first, rows = r["__bucket"] + 1, 0
    if rows:
        batches.append((first, FLUSH_BUCKETS - 1))
    for low, high in batches:
        append(staged.filter(F.col("__bucket").between(low, high)).drop("__bucket"), name, **kw)
    return len(batches)
