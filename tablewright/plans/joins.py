"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import joins as ops
from tablewright.operators.audit import tables_with_tag
from tablewright.operators.merge import merge as merge_rows
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
)
def left_join(t: Tables) -> DataFrame:
    """Orders enriched with their customer, joined on one shared column."""
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    joined = t.orders.join(customers, "o_custkey", "left")
    return joined.select("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment")


def tables_and_tags(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A catalog of tables named after nations and customers, and tags on some of them."""
    catalog = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.lit("production_data").alias("table_catalog"),
        F.lower("n_name").alias("table_schema"),
        F.lower("c_name").alias("table_name"),
        F.col("c_mktsegment").alias("comment"),
    )
    tags = catalog.select(
        F.col("table_catalog").alias("catalog_name"),
        F.col("table_schema").alias("schema_name"),
        "table_name",
        F.lit("data_classification").alias("tag_name"),
        F.when(F.col("comment") == "BUILDING", F.lit("PII")).otherwise(F.lit("CONFIDENTIAL")).alias("tag_value"),
    )
    return catalog, tags


TABLES_AND_TAGS = """catalog AS (
  SELECT 'production_data' AS table_catalog, lower(n_name) AS table_schema, lower(c_name) AS table_name,
         c_mktsegment AS comment
  FROM nation JOIN customer ON n_nationkey = c_nationkey),
tags AS (
  SELECT table_catalog AS catalog_name, table_schema AS schema_name, table_name,
         'data_classification' AS tag_name,
         CASE WHEN comment = 'BUILDING' THEN 'PII' ELSE 'CONFIDENTIAL' END AS tag_value
  FROM catalog)"""


@query(
    f"""WITH {TABLES_AND_TAGS}
    SELECT c.table_catalog, c.table_schema, c.table_name, c.comment, g.tag_value
    FROM catalog c JOIN tags g ON c.table_catalog = g.catalog_name AND c.table_schema = g.schema_name
      AND c.table_name = g.table_name WHERE g.tag_name = 'data_classification'"""
)
def inner_join_multi(t: Tables) -> DataFrame:
    """Tables and tags by catalog, schema and name."""
    catalog, tags = tables_and_tags(t)
    named = tags.withColumnsRenamed({"catalog_name": "table_catalog", "schema_name": "table_schema"})
    joined = catalog.join(named, ["table_catalog", "table_schema", "table_name"])
    return joined.filter(F.col("tag_name") == "data_classification").drop("tag_name")


@query(
    f"""WITH {TABLES_AND_TAGS}
    SELECT c.* FROM catalog c JOIN tags g ON c.table_catalog = g.catalog_name AND c.table_schema = g.schema_name
      AND c.table_name = g.table_name WHERE g.tag_name = 'data_classification' AND g.tag_value = 'PII'"""
)
def tag_lookup(t: Tables) -> DataFrame:
    return tables_with_tag(*tables_and_tags(t), "data_classification", "PII")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, s_name, s_nationkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
)
def broadcast_join(t: Tables) -> DataFrame:
    """Suppliers are replicated as long as they measure below the limit."""
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    joined = ops.broadcast_join(t.lineitem, suppliers, "l_suppkey")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "s_name", "s_nationkey")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey, o_orderpriority
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
)
def salted_join(t: Tables) -> DataFrame:
    """Order lines enriched with their order; orders with an outsized share are split."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return ops.salted_join(lines, orders, ["l_orderkey"], "left")


@query(
    """SELECT event_id, e.event_type, user_id, seen, users FROM events e
    LEFT JOIN (SELECT event_type, count(*) AS seen, count(DISTINCT user_id) AS users FROM events GROUP BY event_type) s
      ON e.event_type = s.event_type"""
)
def salted_join_budget(t: Tables) -> DataFrame:
    """Events with figures of their kind: of the few kinds each is split into tasks of about 500 rows."""
    kinds = t.events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("seen"), F.count_distinct("user_id").alias("users")
    )
    events = t.events.select("event_id", "event_type", "user_id")
    return ops.salted_join(events, kinds, ["event_type"], "left", task_rows=500)


@query(
    f"""WITH {inputs.SALES_SPLIT}
    SELECT l.id, CASE WHEN u.id IS NOT NULL THEN u.ts ELSE l.ts END AS ts,
      CASE WHEN u.id IS NOT NULL THEN u.country ELSE l.country END AS country,
      CASE WHEN u.id IS NOT NULL THEN u.amount ELSE l.amount END AS amount
    FROM loaded l LEFT JOIN updates u ON l.id = u.id AND l.amount < 150000 AND u.ts >= l.ts
    UNION ALL
    SELECT u.* FROM updates u
    WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.id = u.id AND l.amount < 150000 AND u.ts >= l.ts)"""
)
def merge(t: Tables) -> DataFrame:
    """Only open sales, those below an amount, are replaced; a change of any other becomes a row of its own."""
    still_open = "t.amount < 150000 AND s.ts >= t.ts"
    return merge_rows(inputs.sales_loaded(t), inputs.sales_updates(t), on=["id"], condition=still_open)


@query(
    f"""WITH {inputs.SALES_SPLIT}
    SELECT l.* FROM loaded l WHERE EXISTS (SELECT 1 FROM updates u WHERE u.id = l.id)"""
)
def touched_keys(t: Tables) -> DataFrame:
    """Rows that a batch makes necessary to recompute."""
    return ops.touched_rows(inputs.sales_loaded(t), inputs.sales_updates(t), ["id"])
