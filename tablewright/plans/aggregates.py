"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import aggregates as ops
from tablewright.operators import profile
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables

MONEY = "decimal(18,2)"


@query(
    """SELECT o_orderdate, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderdate"""
)
def group_sum(t: Tables) -> DataFrame:
    """Revenue per order date."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    revenue = F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double")
    return joined.groupBy("o_orderdate").agg(revenue.alias("total_revenue"))


@query(
    """SELECT p_brand,
      CAST(sum(CASE WHEN quarter(o_orderdate) = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "1",
      CAST(sum(CASE WHEN quarter(o_orderdate) = 2 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "2",
      CAST(sum(CASE WHEN quarter(o_orderdate) = 3 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "3",
      CAST(sum(CASE WHEN quarter(o_orderdate) = 4 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS "4"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""
)
def pivot_sum(t: Tables) -> DataFrame:
    """Revenue per brand, one column per quarter; the quarters are known, so no extra job."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    sales = joined.select("p_brand", F.quarter("o_orderdate").alias("q"), F.col("l_extendedprice").cast(MONEY).alias("r"))
    return sales.groupBy("p_brand").pivot("q", [1, 2, 3, 4]).agg(F.sum("r").cast("double"))


@query("SELECT count(*) AS row_count FROM lineitem")
def count_all(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("row_count"))


@query(f"WITH {inputs.SALES} SELECT country, count(*) AS n FROM sales GROUP BY country")
def freq_table(t: Tables) -> DataFrame:
    """Values with their counts, most frequent first."""
    counts = inputs.sales(t).groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "country")


_PEOPLE_COLUMNS = ["userId", "country", "age", "date_str", "gender", "email", "phone", "name", "price", "temp_flag"]


@query(
    f"""WITH {inputs.PEOPLE},
    c AS (SELECT {", ".join(f'count(*) - count("{c}") AS "{c}"' for c in _PEOPLE_COLUMNS)} FROM people)
    {" UNION ALL ".join(f"SELECT '{c}' AS column_name, " + f'"{c}" AS nulls FROM c' for c in _PEOPLE_COLUMNS)}"""
)
def null_counts(t: Tables) -> DataFrame:
    return profile.null_counts(inputs.people(t))


_NDV_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, TRUE AS close FROM orders GROUP BY 1" for c in _NDV_COLUMNS)
)
def ndv_counts(t: Tables) -> DataFrame:
    """The estimates of distinct values, checked against exact counts."""
    estimate = profile.ndv_counts(t.orders)
    exact = t.orders.select(*[F.count_distinct(c).alias(c) for c in _NDV_COLUMNS])
    exact = exact.unpivot([], _NDV_COLUMNS, "column_name", "exact")
    error = F.abs(F.col("ndv") - F.col("exact")) / F.col("exact")
    # One row per column on both sides.
    return estimate.join(F.broadcast(exact), "column_name").select("column_name", (error <= 0.1).alias("close"))


@query(
    f"""WITH {inputs.AUDIT}
    SELECT email, count(*) AS n, count(DISTINCT resource) AS resources, max(event_time) AS last_activity
    FROM audit GROUP BY email HAVING count(*) > 50"""
)
def having_count(t: Tables) -> DataFrame:
    grouped = inputs.audit_log(t).groupBy(F.col("user_identity.email").alias("email")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("request_params.full_name_arg").alias("resources"),
        F.max("event_time").alias("last_activity"),
    )
    return grouped.filter(F.col("n") > 50).orderBy(F.desc("n"), "email")


@query(
    """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
      count(l_quantity) AS n, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_returnflag"""
)
def two_phase_agg(t: Tables) -> DataFrame:
    """Three groups, each with a third of the rows, reduced by many tasks."""
    lines = t.lineitem.withColumn("price", F.col("l_extendedprice").cast(MONEY))
    totals = ops.two_phase_agg(
        lines,
        ["l_returnflag"],
        {
            "revenue": ("sum", "price"),
            "n": ("count", "l_quantity"),
            "first_ship": ("min", "l_shipdate"),
            "last_ship": ("max", "l_shipdate"),
        },
    )
    return totals.withColumn("revenue", F.col("revenue").cast("double"))
