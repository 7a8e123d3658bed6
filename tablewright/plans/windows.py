"""Window functions, sorting, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import ordered
from tablewright.operators.clean import dedup
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


def _sales_by_category(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("sales"),
    )


_SALES = """SELECT o_orderkey AS id, o_orderpriority AS category, CAST(o_totalprice AS DECIMAL(18,2)) AS sales FROM orders"""


@query(
    f"""SELECT id, category, rank() OVER (PARTITION BY category ORDER BY sales DESC) AS sales_rank FROM ({_SALES})"""
)
def rank_in_group(t: Tables) -> DataFrame:
    ranked = ordered.rank_in_group(_sales_by_category(t), ["category"], ["-sales"], "sales_rank")
    return ranked.select("id", "category", "sales_rank")


@query(
    f"""SELECT * FROM (SELECT id, category, CAST(sales AS DOUBLE) AS sales,
      rank() OVER (PARTITION BY category ORDER BY sales DESC) AS sales_rank FROM ({_SALES})) WHERE sales_rank <= 3"""
)
def topn_per_group(t: Tables) -> DataFrame:
    best = ordered.top_n(_sales_by_category(t), ["category"], ["-sales"], 3, "sales_rank")
    return best.withColumn("sales", F.col("sales").cast("double"))


@query(
    f"""SELECT id, category, CAST(sum(sales) OVER (PARTITION BY category ORDER BY sales DESC, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM ({_SALES})"""
)
def running_total(t: Tables) -> DataFrame:
    """The order id breaks ties, so that every row has one total."""
    totals = ordered.running_total(_sales_by_category(t), ["category"], ["-sales", "id"], "sales", "running_total")
    return totals.select("id", "category", F.col("running_total").cast("double").alias("running_total"))


@query(
    f"""SELECT id, category, rank() OVER (PARTITION BY category ORDER BY sales DESC) AS sales_rank,
      CAST(sum(sales) OVER (PARTITION BY category ORDER BY sales DESC, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM ({_SALES})"""
)
def sliced_windows(t: Tables) -> DataFrame:
    """Rank and running total with tasks of about 1,000 rows, so that every category is cut into slices."""
    sales = _sales_by_category(t)
    ranked = ordered.rank_in_group(sales, ["category"], ["-sales"], "sales_rank", min_rows=1_000)
    totals = ordered.running_total(ranked, ["category"], ["-sales", "id"], "sales", "running_total", min_rows=1_000)
    return totals.select("id", "category", "sales_rank", F.col("running_total").cast("double").alias("running_total"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY {", ".join(c + " DESC" for c in _LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedup_latest(t: Tables) -> DataFrame:
    """The newest row of each order line, in a total order."""
    return dedup(t.lineitem, ["l_orderkey", "l_linenumber"], [f"-{c}" for c in _LINE_ORDER])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def sort_limit(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("SELECT least(count(*), 5) AS n FROM lineitem")
def peek(t: Tables) -> DataFrame:
    """Any five rows; which ones is open, so they are counted here."""
    return t.lineitem.limit(5).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS row_count, TRUE AS size_plausible, TRUE AS within_table, TRUE AS repeatable FROM lineitem")
def sample_rows(t: Tables) -> DataFrame:
    """A sample of one in a thousand rows, drawn with a seed: its size, its origin, and that the seed gives it again."""
    keys = ["l_orderkey", "l_linenumber"]

    def drawn(flag: str) -> DataFrame:
        rows = t.lineitem.sample(withReplacement=False, fraction=0.001, seed=42).select(*keys)
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(flag))

    present = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("present"))
    rows = present.join(drawn("first"), keys, "full_outer").join(drawn("second"), keys, "full_outer")
    first, second = F.coalesce("first", F.lit(0)), F.coalesce("second", F.lit(0))
    totals = rows.agg(
        F.sum("present").alias("row_count"),
        F.sum(first).alias("n"),
        F.count_if(first > F.coalesce("present", F.lit(0))).alias("foreign"),
        F.count_if(first != second).alias("changed"),
    )
    # Six standard deviations of a binomial count, and one row for tiny tables.
    expected = F.col("row_count") * 0.001
    return totals.select(
        "row_count",
        (F.abs(F.col("n") - expected) <= 6 * F.sqrt(expected) + 1).alias("size_plausible"),
        (F.col("foreign") == 0).alias("within_table"),
        (F.col("changed") == 0).alias("repeatable"),
    )


@query(
    f"""WITH {inputs.SALES_SPLIT}
    SELECT id, ts, country, amount FROM loaded UNION ALL SELECT id, ts, country, amount FROM updates"""
)
def union_by_name(t: Tables) -> DataFrame:
    """Columns are matched by name, whatever their order."""
    updates = inputs.sales_updates(t).select("amount", "country", "ts", "id")
    return inputs.sales_loaded(t).unionByName(updates)


@query("SELECT DISTINCT * FROM lineitem")
def drop_duplicates(t: Tables) -> DataFrame:
    """Whole rows once each, from the table united with itself."""
    return t.lineitem.unionAll(t.lineitem).dropDuplicates()


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""
)
def drop_duplicates_key(t: Tables) -> DataFrame:
    """The first order of each customer: 'first' needs an order to mean anything."""
    return dedup(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
