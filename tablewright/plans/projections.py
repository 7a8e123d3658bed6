"""Projections, filters, predicates and conditional logic."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.columns import moment, safe_divide
from tablewright.operators.audit import newer_than
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


@query("SELECT o_orderkey, 'SystemA' AS source_system FROM orders")
def lit_column(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.lit("SystemA").alias("source_system"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_quantity AS revenue FROM lineitem"""
)
def derive_product(t: Tables) -> DataFrame:
    revenue = F.col("l_extendedprice") * F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", revenue.alias("revenue"))


@query(
    """SELECT o_orderkey, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""
)
def rename_column(t: Tables) -> DataFrame:
    return t.orders.withColumnRenamed("o_custkey", "customer_id")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
      l_extendedprice < l_quantity * p_retailprice AS is_discounted
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
)
def expr_column(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    discounted = F.expr("l_extendedprice < l_quantity * p_retailprice")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", discounted.alias("is_discounted"))


@query("SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def drop_column(t: Tables) -> DataFrame:
    return t.customer.drop("c_acctbal", "c_nationkey")


@query(f"WITH {inputs.SALES} SELECT *, CAST(NULL AS VARCHAR) AS channel FROM sales")
def add_column(t: Tables) -> DataFrame:
    return inputs.sales(t).withColumn("channel", F.lit(None).cast("string"))


@query(f"WITH {inputs.SALES} SELECT id, CAST(amount AS DECIMAL(18,2)) AS amount FROM sales")
def widen_column(t: Tables) -> DataFrame:
    return inputs.sales(t).select("id", F.col("amount").cast("decimal(18,2)").alias("amount"))


@query(f'WITH {inputs.CDC} SELECT "userId", name, city FROM cdc')
def select_star_except(t: Tables) -> DataFrame:
    """Everything but the technical columns of a change event."""
    return inputs.cdc_events(t).drop("operation", "sequenceNum")


@query(
    f"""WITH {inputs.PEOPLE}
    SELECT "userId", CASE WHEN price > 5000 THEN 'Premium' WHEN price > 1000 THEN 'Standard' ELSE 'Basic' END
      AS customer_segment FROM people"""
)
def case_when(t: Tables) -> DataFrame:
    """Three segments, the first true condition wins; an unknown amount is in the last."""
    spent = F.col("price")
    segment = F.when(spent > 5000, "Premium").when(spent > 1000, "Standard").otherwise("Basic")
    return inputs.people(t).select("userId", segment.alias("customer_segment"))


@query(
    f"""WITH {inputs.PEOPLE}
    SELECT "userId", price FROM people WHERE price >= 100 AND price <= 9000"""
)
def range_filter(t: Tables) -> DataFrame:
    price = F.col("price")
    return inputs.people(t).filter((price >= 100) & (price <= 9000)).select("userId", "price")


@query(f'WITH {inputs.PEOPLE} SELECT "userId", price FROM people WHERE price IS NOT NULL')
def not_null_filter(t: Tables) -> DataFrame:
    return inputs.people(t).filter(F.col("price").isNotNull()).select("userId", "price")


@query(
    """SELECT o_orderkey, o_orderpriority, o_orderstatus, o_orderdate FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '1-%'
      AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'"""
)
def in_like_between(t: Tables) -> DataFrame:
    first, last = (moment(d) for d in (datetime(1996, 1, 1), datetime(1998, 12, 31)))
    return t.orders.filter(
        F.col("o_orderstatus").isin("F", "O")
        & F.col("o_orderpriority").like("1-%")
        & F.col("o_orderdate").between(first, last)
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")


@query(
    """SELECT event_id, ts, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 7 DAY"""
)
def recent_window_filter(t: Tables) -> DataFrame:
    recent = newer_than(t.events, "ts", inputs.AUDIT_NOW, timedelta(days=7))
    return recent.select("event_id", "ts", "event_type")


@query(
    f"""WITH {inputs.AUDIT}
    SELECT event_time, email, resource, status_code FROM audit"""
)
def nested_field(t: Tables) -> DataFrame:
    return inputs.audit_log(t).select(
        "event_time",
        F.col("user_identity.email").alias("email"),
        F.col("request_params.full_name_arg").alias("resource"),
        F.col("response.status_code").alias("status_code"),
    )


@query(
    """SELECT c_custkey, coalesce(max(o_orderkey), 0) + 1 AS next_key,
      count(o_orderkey) * 1.0 / NULLIF(count(DISTINCT o_orderstatus), 0) AS orders_per_status
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""
)
def coalesce_nullif(t: Tables) -> DataFrame:
    """Customers without orders give a next key of 1, and NULL rather than a division error."""
    joined = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.groupBy("c_custkey").agg(
        (F.coalesce(F.max("o_orderkey"), F.lit(0)) + 1).alias("next_key"),
        safe_divide(F.count("o_orderkey"), F.count_distinct("o_orderstatus")).alias("orders_per_status"),
    )
