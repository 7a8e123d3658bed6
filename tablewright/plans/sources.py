"""Scans, sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tablewright.operators.changes import as_of, read_changes
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.session import scratch
from tablewright.sources import tables as io
from tablewright.sources.tables import Tables


@query("SELECT * FROM lineitem")
def scan_parquet(t: Tables) -> DataFrame:
    return t.lineitem


@query(
    f"""WITH {inputs.SALES_SPLIT}
    SELECT id, ts, country, amount, CAST(NULL AS VARCHAR) AS channel FROM loaded
    UNION ALL SELECT id, ts, country, amount, 'web' FROM updates"""
)
def sink_merge_schema(t: Tables) -> DataFrame:
    """Two loads with different columns in one table."""
    path = scratch(t.spark, "sink_merge_schema")
    io.append_evolving(inputs.sales_loaded(t), path)
    io.append_evolving(inputs.sales_updates(t).withColumn("channel", F.lit("web")), path)
    return io.read_evolving(t.spark, path)


@query(
    f"""WITH {inputs.CHANGE_LOG}
    SELECT * FROM log
    WHERE _commit_timestamp >= TIMESTAMP '2024-01-08' AND _commit_timestamp <= TIMESTAMP '2024-01-16'
      AND _change_type IN ('insert', 'update_postimage', 'delete')"""
)
def read_change_feed(t: Tables) -> DataFrame:
    kinds = ["insert", "update_postimage", "delete"]
    return read_changes(inputs.change_log(t), datetime(2024, 1, 8), inputs.MIDDLE, kinds)


@query(
    """SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS dt FROM events"""
)
def ctas_partitioned(t: Tables) -> DataFrame:
    """Events written as a table partitioned by the day of their timestamp."""
    path = scratch(t.spark, "ctas_partitioned")
    io.write_partitioned(t.events.withColumn("dt", F.to_date("ts")), path, ["dt"])
    return t.spark.read.parquet(path)


@query(
    """SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-16' THEN value + 1 ELSE value END AS value,
      CAST(ts AS DATE) AS dt FROM events"""
)
def overwrite_partitions(t: Tables) -> DataFrame:
    """Recent days computed anew and put in place of what was there."""
    path = scratch(t.spark, "overwrite_partitions")
    daily = t.events.select("event_id", "user_id", "value", F.to_date("ts").alias("dt"))
    io.write_partitioned(daily, path, ["dt"])
    recent = daily.filter(F.col("dt") >= F.lit("2024-01-16").cast("date")).withColumn("value", F.col("value") + 1)
    io.overwrite_partitions(recent, path, ["dt"])
    return t.spark.read.parquet(path)


@query(
    f"""WITH {inputs.CHANGE_LOG},
    {inputs.STATE.format(name="state", condition="_commit_timestamp <= TIMESTAMP '2024-01-16'")}
    SELECT TRUE AS same_count, TRUE AS same_content, count(*) AS row_count FROM state"""
)
def deep_copy(t: Tables) -> DataFrame:
    """A full copy of a past state, compared with its origin."""
    past = as_of(inputs.change_log(t), ["id"], inputs.MIDDLE)
    return io.deep_copy(past, scratch(t.spark, "deep_copy"))
