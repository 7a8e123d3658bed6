"""MERGE, UPDATE and DELETE as dataflow."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.columns import moment
from tablewright.operators import changes
from tablewright.operators.merge import ALL, DELETE, delete_where as delete_rows, merge, update_where as update_rows
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables

NOW = datetime(2024, 6, 1, 8, 0, 0)
CREATED = datetime(2024, 1, 1)


@query(
    f"""WITH {inputs.SALES_SPLIT}
    SELECT * FROM updates UNION ALL SELECT * FROM loaded l WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE u.id = l.id)"""
)
def merge_upsert_all(t: Tables) -> DataFrame:
    return merge(inputs.sales_loaded(t), inputs.sales_updates(t), on=["id"])


@query(
    """SELECT coalesce(c_custkey, s_suppkey) AS unique_business_key,
      coalesce(c_name, s_name) AS col1, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE 'none' END AS col2,
      CASE WHEN s_suppkey IS NOT NULL THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01 08:00:00' END AS created_ts,
      CASE WHEN c_custkey IS NOT NULL THEN TIMESTAMP '2024-06-01 08:00:00' ELSE TIMESTAMP '2024-01-01' END AS last_updated_ts
    FROM supplier FULL OUTER JOIN customer ON s_suppkey = c_custkey"""
)
def merge_upsert_cols(t: Tables) -> DataFrame:
    """The time of creation survives an update, the time of the last update is renewed."""
    created, now = (moment(d) for d in (CREATED, NOW))
    target = t.supplier.select(
        F.col("s_suppkey").alias("unique_business_key"),
        F.col("s_name").alias("col1"),
        F.lit("none").alias("col2"),
        created.alias("created_ts"),
        created.alias("last_updated_ts"),
    )
    source = t.customer.select(
        F.col("c_custkey").alias("unique_business_key"), F.col("c_name").alias("col1"), F.col("c_mktsegment").alias("col2")
    )
    return merge(
        target,
        source,
        on=["unique_business_key"],
        matched=[(None, {"col1": "s.col1", "col2": "s.col2", "last_updated_ts": now})],
        not_matched=[
            (
                None,
                {
                    "unique_business_key": "s.unique_business_key",
                    "col1": "s.col1",
                    "col2": "s.col2",
                    "created_ts": now,
                    "last_updated_ts": now,
                },
            )
        ],
    )


@query(
    """WITH change AS (
      SELECT p_partkey AS id, p_name AS name, p_retailprice AS balance,
        CASE WHEN p_type = 'ECONOMY' THEN 'delete' WHEN p_type = 'SMALL' THEN 'insert' ELSE 'update_postimage' END AS kind
      FROM part)
    SELECT c_custkey AS id, CASE WHEN kind = 'update_postimage' THEN name ELSE c_name END AS name,
      CASE WHEN kind = 'update_postimage' THEN balance ELSE c_acctbal END AS balance
    FROM customer LEFT JOIN change ON id = c_custkey WHERE kind IS NULL OR kind <> 'delete'
    UNION ALL
    SELECT id, name, balance FROM change
    WHERE kind = 'insert' AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = id)"""
)
def merge_conditional(t: Tables) -> DataFrame:
    """Updates, deletes and inserts, each only where its condition holds."""
    target = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    kind = F.when(F.col("p_type") == "ECONOMY", F.lit("delete")).when(F.col("p_type") == "SMALL", F.lit("insert"))
    source = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("balance"),
        kind.otherwise(F.lit("update_postimage")).alias("_change_type"),
    )
    return merge(
        target,
        source,
        on=["id"],
        matched=[("s._change_type = 'update_postimage'", ALL), ("s._change_type = 'delete'", DELETE)],
        not_matched=[("s._change_type = 'insert'", ALL)],
    )


@query(
    """SELECT coalesce(p_partkey, c_custkey) AS id, coalesce(p_name, c_name) AS name, c_mktsegment AS segment,
      p_brand AS brand
    FROM customer FULL OUTER JOIN part ON p_partkey = c_custkey"""
)
def merge_evolve(t: Tables) -> DataFrame:
    """A source with a new column: the target gains it, its own columns stay."""
    target = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    source = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return merge(target, source, on=["id"], evolve=True)


@query(f"WITH {inputs.SALES} SELECT * FROM sales WHERE NOT coalesce(ts < DATE '2001-06-01' - 365, FALSE)")
def delete_where(t: Tables) -> DataFrame:
    """Rows older than a year before a given day are removed."""
    today = F.lit(date(2001, 6, 1))
    return delete_rows(inputs.sales(t), F.to_date("ts") < F.date_sub(today, 365))


@query(f"WITH {inputs.SALES} SELECT id, ts, coalesce(country, 'UNK') AS country, amount FROM sales")
def update_where(t: Tables) -> DataFrame:
    return update_rows(inputs.sales(t), "country IS NULL", {"country": F.lit("UNK")})


def _marks(t: Tables) -> DataFrame:
    """High-water marks: the feed of events was processed up to the middle of the month."""
    reached = inputs.change_log(t).filter(
        F.col("_commit_timestamp") <= moment(inputs.MIDDLE)
    )
    return reached.groupBy(F.lit("events").alias("table_name")).agg(F.max("_commit_version").alias("processed_version"))


@query(
    f"""WITH {inputs.CHANGE_LOG},
    mark AS (SELECT max(_commit_version) AS v FROM log WHERE _commit_timestamp <= TIMESTAMP '2024-01-16')
    SELECT 'events' AS table_name, v + 1 AS start_version, (SELECT max(_commit_version) FROM log) AS processed_version
    FROM mark"""
)
def high_water_mark(t: Tables) -> DataFrame:
    """Where the next run starts, and where the mark stands after it."""
    mark = _marks(t)
    start = changes.next_version(mark, "events")
    pending = changes.read_changes(inputs.change_log(t), start=start.scalar())
    advanced = changes.advance_mark(mark, "events", pending.agg(F.max("_commit_version")))
    return advanced.select("table_name", start.scalar().alias("start_version"), "processed_version")


@query(
    f"""WITH {inputs.CHANGE_LOG}, {inputs.STATE.format(name="state", condition="TRUE")}
    SELECT id, name, props, (SELECT max(_commit_version) FROM log) AS processed_version FROM state"""
)
def apply_change_feed(t: Tables) -> DataFrame:
    """A table as of the middle of the month, brought up to date from the change feed."""
    log = inputs.change_log(t)
    past = changes.as_of(log, ["id"], inputs.MIDDLE)
    state, marks = changes.apply_change_feed(past, log, _marks(t), "events", ["id"])
    reached = marks.filter(F.col("table_name") == "events").select("processed_version")
    return state.withColumn("processed_version", reached.scalar())
