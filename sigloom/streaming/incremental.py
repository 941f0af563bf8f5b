"""Incremental append of ready rows from a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigloom.sources.tables import append, not_done, optional_scan


def append_ready(stream: DataFrame, name: str, key: str, checkpoint: str, *, fmt: str = "parquet", batch_column: str = "batch_id", **trigger) -> StreamingQuery:
    """Append each micro-batch with its number in `batch_column`, once.

    The checkpoint makes the stream resumable. A replayed batch is harmless: rows of a key that the table already holds from
    the same batch are left out. An entity whose rows come in several batches keeps them all.
    """

    def write(batch: DataFrame, number: int) -> None:
        done = optional_scan(batch.sparkSession, name, [key, batch_column])
        done = done if done is None else done.filter(F.col(batch_column) == number).select(key)
        append(not_done(batch, done, key).withColumn(batch_column, F.lit(number).cast("long")), name, fmt=fmt)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
