"""Layout jobs and table health."""

from __future__ import annotations

import math
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.columns import moment
from tablewright.operators import layout
from tablewright.plans.registry import query
from tablewright.session import scratch
from tablewright.sources import tables as io
from tablewright.sources.tables import Tables


def _files(spark: SparkSession, path: str, at_least: int = 16) -> int:
    """Files of the target size for a table, or a few more so that skipping shows on a small one."""
    size = io.list_files(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return max(at_least, math.ceil(size / layout.TARGET_BYTES))


def _compare(before: DataFrame, after: DataFrame, smaller: DataFrame, larger: DataFrame, name: str) -> DataFrame:
    """One row: do both tables hold the same rows, and is one count below the other?"""
    sums = io.table_checksum(before).unionByName(io.table_checksum(after.select(before.columns)))
    return sums.agg(
        (F.min("row_count") == F.max("row_count")).alias("same_count"),
        (F.min("content_sum") == F.max("content_sum")).alias("same_content"),
        F.max("row_count").alias("row_count"),
    ).withColumn(name, smaller.scalar() < larger.scalar())


@query("SELECT TRUE AS same_count, TRUE AS same_content, TRUE AS fewer_files, count(*) AS row_count FROM lineitem")
def compact_files(t: Tables) -> DataFrame:
    """A table in many small files, rewritten into few."""
    small, large = scratch(t.spark, "compact-small"), scratch(t.spark, "compact-large")
    t.lineitem.repartition(4 * _files(t.spark, f"{t.folder}/lineitem.parquet")).write.parquet(small)
    layout.compact(t.spark, small, large)

    def count(path: str) -> DataFrame:
        return io.list_files(t.spark, path).agg(F.count(F.lit(1)))

    return _compare(t.lineitem, t.spark.read.parquet(large), count(large), count(small), "fewer_files")


# A query for a range of two columns, as layout jobs are meant to speed up.
_RANGES = {
    "l_partkey": (100, 199),
    "l_shipdate": (datetime(1998, 1, 1), datetime(1998, 6, 30)),
}


def _read_by(t: Tables, path: str, asked: dict) -> DataFrame:
    """How many files of a table the range query has to open, as one value."""
    ranges = {
        c: tuple(moment(v) if isinstance(v, datetime) else F.lit(v) for v in bounds)
        for c, bounds in asked.items()
    }
    report = layout.skipping_report(t.spark.read.parquet(path), list(asked), ranges)
    return report.agg(F.count_if("must_read"))


def _layout_check(
    t: Tables, table: DataFrame, placed: DataFrame, files: int, label: str, asked: dict = _RANGES
) -> DataFrame:
    plain, ordered = scratch(t.spark, f"{label}-plain"), scratch(t.spark, f"{label}-ordered")
    table.repartition(files).write.parquet(plain)
    placed.write.parquet(ordered)
    return _compare(
        table, t.spark.read.parquet(ordered), _read_by(t, ordered, asked), _read_by(t, plain, asked), "fewer_files_read"
    )


_LAYOUT_SQL = """SELECT TRUE AS same_count, TRUE AS same_content, TRUE AS fewer_files_read, count(*) AS row_count
    FROM lineitem"""


@query(_LAYOUT_SQL)
def zorder_layout(t: Tables) -> DataFrame:
    """Order lines along a curve over part and ship date."""
    files = _files(t.spark, f"{t.folder}/lineitem.parquet")
    placed = layout.zorder(t.lineitem, ["l_partkey", "l_shipdate"], files)
    return _layout_check(t, t.lineitem, placed, files, "zorder")


@query(_LAYOUT_SQL.replace("lineitem", "customer"))
def zorder_text(t: Tables) -> DataFrame:
    """Customers along a curve over name and balance: the names agree in their first nine characters and more."""
    files = _files(t.spark, f"{t.folder}/customer.parquet")
    asked = {"c_name": ("Customer#000000010", "Customer#000000019")}
    placed = layout.zorder(t.customer, ["c_name", "c_acctbal"], files)
    return _layout_check(t, t.customer, placed, files, "zorder-text", asked)


@query(_LAYOUT_SQL)
def cluster_layout(t: Tables) -> DataFrame:
    files = _files(t.spark, f"{t.folder}/lineitem.parquet")
    placed = layout.cluster(t.lineitem, ["l_shipdate", "l_partkey"], files)
    return _layout_check(t, t.lineitem, placed, files, "cluster")


@query(
    """SELECT TRUE AS all_files, count(*) AS row_count, min(l_partkey) AS low, max(l_partkey) AS high,
      TRUE AS some_skipped FROM lineitem"""
)
def skipping_report(t: Tables) -> DataFrame:
    """Bounds per file of a table sorted by part, summed up over all files."""
    path = scratch(t.spark, "skipping")
    files = _files(t.spark, f"{t.folder}/lineitem.parquet")
    layout.cluster(t.lineitem, ["l_partkey"], files).write.parquet(path)
    report = layout.skipping_report(t.spark.read.parquet(path), ["l_partkey"], {"l_partkey": _RANGES["l_partkey"]})
    present = io.list_files(t.spark, path).agg(F.count(F.lit(1))).scalar()
    totals = report.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("row_count").alias("row_count"),
        F.min("min_l_partkey").alias("low"),
        F.max("max_l_partkey").alias("high"),
        F.count_if(~F.col("must_read")).alias("skipped"),
    )
    return totals.select(
        (F.col("files") == present).alias("all_files"), "row_count", "low", "high", (F.col("skipped") > 0).alias("some_skipped")
    )


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, TRUE AS same_bytes, 'OK' AS status FROM {name} HAVING count(*) > 0"
        for name in _TABLES
    )
)
def file_health(t: Tables) -> DataFrame:
    """Rows and verdict of each given table by the files that a scan meets; their bytes are those of the listing."""
    scanned = reduce(DataFrame.unionByName, [layout.scanned_files(getattr(t, name), name) for name in _TABLES])
    rows = scanned.groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
    health = layout.file_health(scanned)
    table = F.regexp_extract("path", r"([^/]+)\.parquet(?:/|$)", 1)
    listed = io.list_files(t.spark, t.folder).groupBy(table.alias("table_name")).agg(F.sum("length").alias("listed"))
    joined = health.join(rows, "table_name").join(listed, "table_name")
    return joined.select("table_name", "row_count", (F.col("size_in_bytes") == F.col("listed")).alias("same_bytes"), "status")


@query(
    """SELECT column_name, count(*) AS row_count, count(*) - count(v) AS nulls, min(v) AS min, max(v) AS max
    FROM (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS v FROM orders
          UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders) GROUP BY column_name"""
)
def column_stats(t: Tables) -> DataFrame:
    stats = layout.column_stats(t.orders, ["o_orderstatus", "o_orderpriority"])
    return stats.select("column_name", "row_count", "nulls", "min", "max")


@query(
    """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS dt FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"""
)
def partition_pruned_scan(t: Tables) -> DataFrame:
    """Three days of a table partitioned by day: the others are not read."""
    path = scratch(t.spark, "pruned")
    daily = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("dt"))
    io.write_partitioned(daily, path, ["dt"])
    days = F.col("dt").between(F.lit(date(2024, 1, 10)), F.lit(date(2024, 1, 12)))
    return t.spark.read.parquet(path).filter(days)


@query(
    """SELECT column_name, CASE WHEN ndv > 1000 THEN 'TOO_MANY_VALUES' WHEN max_rows / avg_rows > 3 THEN 'SKEWED' ELSE 'OK' END AS advice
    FROM (SELECT column_name, count(*) AS ndv, max(n) AS max_rows, avg(n) AS avg_rows FROM (
      SELECT 'l_returnflag' AS column_name, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY ALL
      UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY ALL
      UNION ALL SELECT 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem GROUP BY ALL) GROUP BY column_name)"""
)
def partition_advice(t: Tables) -> DataFrame:
    """Which columns of the order lines would do as partition columns."""
    advice = layout.partition_advice(t.lineitem, ["l_returnflag", "l_linenumber", "l_orderkey"], max_values=1000)
    return advice.select("column_name", "advice")
