"""Queries over an access log with nested request fields."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.columns import moment

# Limits of the recent-activity and heavy-user reports.
RECENT_DAYS = 7
RECENT_ROWS = 100
ACTIVE_HOURS = 24
ACTIVE_ACTIONS = 50


def newer_than(df: DataFrame, column: str, now: datetime, interval: timedelta) -> DataFrame:
    """Rows of the last ``interval`` before ``now``. The clock is an argument, never read here."""
    start = moment(now - interval, df.schema[column].dataType)
    return df.filter(F.col(column) >= start)


def row_filter(df: DataFrame, policy: Column) -> DataFrame:
    """The rows a policy lets through; an unknown answer hides the row."""
    return df.filter(policy)


def audit_recent(
    df: DataFrame,
    actions: Collection[str],
    prefix: str,
    now: datetime,
    days: int = RECENT_DAYS,
    n: int = RECENT_ROWS,
) -> DataFrame:
    """The newest ``n`` actions on objects whose name starts with ``prefix``; ties go by the other columns, NULLs last."""
    name = F.col("request_params.full_name_arg")
    return (
        newer_than(df, "event_time", now, timedelta(days=days))
        .filter(F.col("action_name").isin(list(actions)) & name.startswith(prefix))
        .select(
            "event_time",
            F.col("user_identity.email").alias("user_email"),
            "action_name",
            name.alias("object_name"),
            "source_ip_address",
        )
        .orderBy(F.desc("event_time"), *[F.asc_nulls_last(c) for c in ("user_email", "action_name", "object_name", "source_ip_address")])
        .limit(n)
    )


def audit_active_users(
    df: DataFrame,
    actions: Collection[str],
    now: datetime,
    hours: int = ACTIVE_HOURS,
    min_count: int = ACTIVE_ACTIONS,
) -> DataFrame:
    """Users with more than ``min_count`` actions in the window, busiest first."""
    return (
        newer_than(df, "event_time", now, timedelta(hours=hours))
        .filter(F.col("action_name").isin(list(actions)))
        .groupBy(F.col("user_identity.email").alias("email"))
        .agg(
            F.count(F.lit(1)).alias("action_count"),
            F.count_distinct("request_params.full_name_arg").alias("unique_resources"),
            F.max("event_time").alias("last_activity"),
        )
        .filter(F.col("action_count") > min_count)
        .orderBy(F.desc("action_count"), "email")
    )


def tables_with_tag(tables: DataFrame, tags: DataFrame, name: str, value: str) -> DataFrame:
    """Tables that carry a tag with the given value."""
    wanted = tags.filter((F.col("tag_name") == name) & (F.col("tag_value") == value))
    wanted = wanted.select(
        F.col("catalog_name").alias("table_catalog"), F.col("schema_name").alias("table_schema"), "table_name"
    )
    return tables.join(wanted, ["table_catalog", "table_schema", "table_name"]).select(
        "table_catalog", "table_schema", "table_name", "comment"
    )
