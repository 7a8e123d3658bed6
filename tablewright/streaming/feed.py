"""Tables and change logs as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.operators.changes import CHANGE_TYPE, INSERT, VERSION
from tablewright.operators.joins import touched_rows


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """A folder of Parquet files as a stream of its new files."""
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest version of a change log, 0 when it is empty."""
    return spark.read.parquet(path).agg(F.coalesce(F.max(VERSION), F.lit(0))).first()[0]


def stream_changes(
    spark: SparkSession, path: str, start: int | str = 0, files_per_batch: int | None = None
) -> DataFrame:
    """A change log as a stream, from a version on, or with ``latest`` only what is still to come."""
    first = latest_version(spark, path) + 1 if start == "latest" else int(start)
    return stream_table(spark, path, files_per_batch=files_per_batch).filter(F.col(VERSION) >= first)


def inserts_only(path: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Pass on the commits that only insert; a commit that updates or deletes is skipped whole.

    Whether a commit does so is looked up in the log itself, because its files may come in
    different batches; only the versions between the batch's first and last are read.
    """

    def filtered(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min(VERSION), F.max(VERSION)).first()
        log = batch.sparkSession.read.parquet(path).filter(F.col(VERSION).between(first, last))
        changing = touched_rows(log.filter(F.col(CHANGE_TYPE) != INSERT).select(VERSION), batch, [VERSION])
        write(touched_rows(batch, changing, [VERSION], "left_anti"), batch_id)

    return filtered


def overwrite_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
