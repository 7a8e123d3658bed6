"""Reading and writing plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.columns import row_fingerprint


class Tables:
    """The tables of one folder, ``tables.lineitem`` for ``<folder>/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Create a partitioned table.

    Rows are gathered by partition value first, so that a task writes few files; the
    rebalance hint lets adaptive execution split a value that holds much of the table.
    """
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; all others stay untouched."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def append_evolving(df: DataFrame, path: str) -> None:
    """Append rows whose schema may have more or fewer columns than the table."""
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files differ in columns; missing ones are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file with its size. Lists the folder; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def table_checksum(df: DataFrame) -> DataFrame:
    """Row count and order-free content sum of a table, as one row."""
    content = row_fingerprint(df.columns).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(content).alias("content_sum"))


def deep_copy(df: DataFrame, path: str) -> DataFrame:
    """Write a full copy and compare it with its origin: one row, ``identical``."""
    df.write.parquet(path)
    origin = table_checksum(df)
    copy = table_checksum(df.sparkSession.read.parquet(path).select(df.columns))
    tagged = origin.unionByName(copy)
    return tagged.agg(
        (F.min("row_count") == F.max("row_count")).alias("same_count"),
        F.min("content_sum").eqNullSafe(F.max("content_sum")).alias("same_content"),
        F.max("row_count").alias("row_count"),
    )
