"""Inputs derived from the given tables, once as DataFrames and once as SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.columns import moment
from tablewright.sources.tables import Tables

LOADED_UNTIL = datetime(2000, 1, 1)
CHANGED_SINCE = datetime(1999, 1, 1)
MIDDLE = datetime(2024, 1, 16)


def sales(t: Tables) -> DataFrame:
    """Sales from orders; an unspecified priority stands for a missing country."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("country"),
        F.col("o_totalprice").alias("amount"),
    )


SALES = """sales AS (
  SELECT o_orderkey AS id, o_orderdate AS ts,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS country,
         o_totalprice AS amount
  FROM orders)"""


def sales_loaded(t: Tables) -> DataFrame:
    """What an earlier load had brought in."""
    return sales(t).filter(F.col("ts") < moment(LOADED_UNTIL))


def sales_updates(t: Tables) -> DataFrame:
    """A batch that overlaps the earlier load: repriced sales, and new ones."""
    batch = sales(t).filter(F.col("ts") >= moment(CHANGED_SINCE))
    return batch.withColumn("amount", F.col("amount") + 10.0)


SALES_SPLIT = (
    SALES
    + """,
loaded AS (SELECT * FROM sales WHERE ts < TIMESTAMP '2000-01-01'),
updates AS (SELECT id, ts, country, amount + 10.0 AS amount FROM sales WHERE ts >= TIMESTAMP '1999-01-01')"""
)


def cdc_events(t: Tables) -> DataFrame:
    """User changes from events: an error deletes the user, a signup inserts, others update."""
    e = t.events
    kind = F.col("event_type")
    return e.select(
        F.col("user_id").alias("userId"),
        kind.alias("name"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("c"), (F.col("event_id") % 7).cast("string"))).alias("city"),
        F.when(kind == "error", F.lit("DELETE")).when(kind == "signup", F.lit("INSERT")).otherwise(F.lit("UPDATE")).alias(
            "operation"
        ),
        F.col("event_id").alias("sequenceNum"),
    )


CDC = """cdc AS (
  SELECT user_id AS "userId", event_type AS name,
         CASE WHEN event_id % 5 <> 0 THEN 'c' || (event_id % 7) END AS city,
         CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         event_id AS "sequenceNum"
  FROM events)"""


def change_log(t: Tables) -> DataFrame:
    """A change log from events, one commit per event."""
    kind = F.col("event_type")
    change = (
        F.when(kind == "error", F.lit("delete"))
        .when(kind == "signup", F.lit("insert"))
        .when(kind == "view", F.lit("update_preimage"))
        .otherwise(F.lit("update_postimage"))
    )
    return t.events.select(
        F.col("user_id").alias("id"),
        kind.alias("name"),
        F.col("props"),
        change.alias("_change_type"),
        (F.col("event_id") + 1).alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"),
    )


CHANGE_LOG = """log AS (
  SELECT user_id AS id, event_type AS name, props,
         CASE event_type WHEN 'error' THEN 'delete' WHEN 'signup' THEN 'insert'
              WHEN 'view' THEN 'update_preimage' ELSE 'update_postimage' END AS _change_type,
         event_id + 1 AS _commit_version, ts AS _commit_timestamp
  FROM events)"""

# Rows of the table ``log`` describes: name of the result, then the condition on the log.
STATE = """{name} AS (
  SELECT id, name, props FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY _commit_version DESC) AS rn
    FROM log WHERE _change_type <> 'update_preimage' AND {condition})
  WHERE rn = 1 AND _change_type <> 'delete')"""


def people(t: Tables) -> DataFrame:
    """Untidy person records from customers, everything as text."""
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    return t.customer.select(
        key.alias("userId"),
        F.when(segment == "BUILDING", F.lit("US"))
        .when(segment == "MACHINERY", F.lit("U.S."))
        .when(segment == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(segment)
        .alias("country"),
        F.when(key % 11 == 0, F.lit("unknown")).when(key % 13 == 0, F.lit(None)).otherwise(
            (key % 150).cast("string")
        ).alias("age"),
        F.when(key % 7 == 0, F.lit("31/12/2023"))
        .otherwise(F.concat(F.lit("2023-0"), (key % 9 + 1).cast("string"), F.lit("-15")))
        .alias("date_str"),
        F.when(key % 2 == 0, F.lit("FEMALE")).otherwise(F.lit("Male")).alias("gender"),
        F.concat(F.lit("  "), F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.com ")).alias("email"),
        F.concat(F.lit("+1 ("), (key % 900 + 100).cast("string"), F.lit(") 555-01"), (key % 90 + 10).cast("string")).alias(
            "phone"
        ),
        F.replace("c_name", F.lit("#"), F.lit("   ")).alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("price"),
        F.lit(1).alias("temp_flag"),
    )


PEOPLE = """people AS (
  SELECT c_custkey AS "userId",
         CASE c_mktsegment WHEN 'BUILDING' THEN 'US' WHEN 'MACHINERY' THEN 'U.S.'
              WHEN 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS country,
         CASE WHEN c_custkey % 11 = 0 THEN 'unknown' WHEN c_custkey % 13 = 0 THEN NULL
              ELSE CAST(c_custkey % 150 AS VARCHAR) END AS age,
         CASE WHEN c_custkey % 7 = 0 THEN '31/12/2023'
              ELSE '2023-0' || (c_custkey % 9 + 1) || '-15' END AS date_str,
         CASE WHEN c_custkey % 2 = 0 THEN 'FEMALE' ELSE 'Male' END AS gender,
         '  ' || lower(replace(c_name, '#', '.')) || '@mail.com ' AS email,
         '+1 (' || (c_custkey % 900 + 100) || ') 555-01' || (c_custkey % 90 + 10) AS phone,
         replace(c_name, '#', '   ') AS name,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS price,
         1 AS temp_flag
  FROM customer)"""


def staff(t: Tables) -> DataFrame:
    """Personal data from customers: department, email (some without a domain), salary."""
    segment = F.col("c_mktsegment")
    name = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(segment == "BUILDING", F.lit("Sales")).when(segment == "MACHINERY", F.lit("Marketing")).when(
            segment != "HOUSEHOLD", segment
        ).alias("department"),
        F.when(segment == "FURNITURE", name)
        .when(segment != "HOUSEHOLD", F.concat(name, F.lit("@"), F.lower(segment), F.lit(".com")))
        .alias("email"),
        (F.col("c_acctbal") * 20).cast("decimal(10,2)").alias("salary"),
    )


STAFF = """staff AS (
  SELECT c_custkey AS customer_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Sales' WHEN 'MACHINERY' THEN 'Marketing'
              WHEN 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS department,
         CASE c_mktsegment WHEN 'FURNITURE' THEN lower(replace(c_name, '#', '.')) WHEN 'HOUSEHOLD' THEN NULL
              ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' END AS email,
         CAST(c_acctbal * 20 AS DECIMAL(10,2)) AS salary
  FROM customer)"""


def audit_log(t: Tables) -> DataFrame:
    """An access log from events, with nested request fields."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "view", F.lit("getTable"))
        .when(kind == "signup", F.lit("createTable"))
        .when(kind == "error", F.lit("deleteTable"))
        .when(kind == "purchase", F.lit("alterTable"))
        .otherwise(F.lit("listTables"))
    )
    place = F.when(F.col("value") < 20, F.lit("production_data.gold.t")).otherwise(F.lit("sandbox.tmp.t"))
    return t.events.select(
        F.col("ts").alias("event_time"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@company.com")).alias("email")).alias(
            "user_identity"
        ),
        action.alias("action_name"),
        F.struct(F.concat(place, F.get_json_object("props", "$.k")).alias("full_name_arg")).alias("request_params"),
        F.struct(F.when(kind == "error", F.lit(403)).otherwise(F.lit(200)).alias("status_code")).alias("response"),
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("source_ip_address"),
    )


AUDIT = """audit AS (
  SELECT ts AS event_time, 'user' || user_id || '@company.com' AS email,
         CASE event_type WHEN 'view' THEN 'getTable' WHEN 'signup' THEN 'createTable'
              WHEN 'error' THEN 'deleteTable' WHEN 'purchase' THEN 'alterTable' ELSE 'listTables' END AS action_name,
         CASE WHEN value < 20 THEN 'production_data.gold.t' ELSE 'sandbox.tmp.t' END
           || json_extract_string(props, '$.k') AS resource,
         CASE event_type WHEN 'error' THEN 403 ELSE 200 END AS status_code,
         '10.0.0.' || (user_id % 256) AS source_ip_address
  FROM events)"""
AUDIT_NOW = datetime(2024, 1, 30, 12, 0, 0)
AUDIT_ACTIONS = ["getTable", "createTable", "deleteTable", "alterTable"]
AUDIT_ACTIONS_SQL = "('getTable', 'createTable', 'deleteTable', 'alterTable')"
