"""Streaming sinks: append and keyed upsert.

A stream must not rewrite a large table per batch. The upsert sink therefore only
writes what a batch brings, into a folder named after the batch, and readers resolve
which rows count. ``fold_upserts`` rewrites the resolved table now and then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.ordered import latest

BATCH = "batch_id"

AVAILABLE_NOW = {"availableNow": True}


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a table, exactly once: Spark's own file sink keeps the record."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return (
        writer.option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def upsert_sink(path: str, keys: Sequence[str], order_by: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Keep one row per key and batch; a later batch replaces the rows of earlier ones.

    ``order_by`` decides between rows of one batch (a leading minus sorts descending).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch, keys, order_by).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The table a keyed upsert stream has produced."""
    return latest(spark.read.parquet(path), keys, [f"-{BATCH}"]).drop(BATCH)


def fold_upserts(spark: SparkSession, path: str, dst: str, keys: Sequence[str]) -> None:
    """Write the resolved table to a new folder as one batch that any later one replaces."""
    read_upserts(spark, path, keys).write.parquet(f"{dst}/{BATCH}=-1")
