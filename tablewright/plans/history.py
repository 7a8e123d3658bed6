"""Change data capture, point-in-time state and slowly changing dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import cdc, changes, scd
from tablewright.plans import inputs
from tablewright.plans.registry import query
from tablewright.plans.scalars import row_hash_sql
from tablewright.sources.tables import Tables

CHANGE_TIME = datetime(2024, 2, 1)
LOAD_TIMES = (datetime(2024, 1, 1), datetime(2024, 2, 1))
TECHNICAL = ["operation", "sequenceNum"]
IS_DELETE = "operation = 'DELETE'"


def _customer_snapshot(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _later_snapshot(t: Tables) -> DataFrame:
    """Debtors are gone, furniture buyers got a bonus, suppliers became customers."""
    kept = _customer_snapshot(t).filter(F.col("c_acctbal") >= 0)
    bonus = F.when(F.col("c_mktsegment") == "FURNITURE", F.col("c_acctbal") + 1.0).otherwise(F.col("c_acctbal"))
    joined = t.supplier.select(
        (F.col("s_suppkey") + F.lit(1_000_000_000)).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
    )
    return kept.withColumn("c_acctbal", bonus).unionByName(joined)


_SNAPSHOTS = """old AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
new AS (
  SELECT c_custkey, c_name, c_nationkey,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN c_acctbal + 1.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_acctbal >= 0
  UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, NULL FROM supplier)"""


@query(
    f"""WITH {_SNAPSHOTS}
    SELECT n.*, 'insert' AS _change_type, CAST(2 AS BIGINT) AS _commit_version, TIMESTAMP '2024-02-01' AS _commit_timestamp
      FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.c_custkey = n.c_custkey)
    UNION ALL
    SELECT o.*, 'delete', 2, TIMESTAMP '2024-02-01'
      FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE o.c_custkey = n.c_custkey)
    UNION ALL
    SELECT o.*, 'update_preimage', 2, TIMESTAMP '2024-02-01'
      FROM old o JOIN new n ON o.c_custkey = n.c_custkey WHERE o.c_acctbal <> n.c_acctbal
    UNION ALL
    SELECT n.*, 'update_postimage', 2, TIMESTAMP '2024-02-01'
      FROM old o JOIN new n ON o.c_custkey = n.c_custkey WHERE o.c_acctbal <> n.c_acctbal"""
)
def snapshot_diff(t: Tables) -> DataFrame:
    return changes.snapshot_diff(_customer_snapshot(t), _later_snapshot(t), ["c_custkey"], 2, CHANGE_TIME)


@query(
    f"""WITH {inputs.CHANGE_LOG}
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY _commit_version DESC) AS rn
      FROM log WHERE _change_type <> 'update_preimage') WHERE rn = 1"""
)
def net_changes(t: Tables) -> DataFrame:
    return changes.net_changes(inputs.change_log(t), ["id"])


@query(
    f"""WITH {inputs.CHANGE_LOG},
    {inputs.STATE.format(name="state", condition="_commit_timestamp <= TIMESTAMP '2024-01-16'")}
    SELECT * FROM state"""
)
def as_of_version(t: Tables) -> DataFrame:
    return changes.as_of(inputs.change_log(t), ["id"], inputs.MIDDLE)


@query(
    f"""WITH {inputs.CHANGE_LOG},
    {inputs.STATE.format(name="present", condition="TRUE")},
    {inputs.STATE.format(name="past", condition="_commit_timestamp <= TIMESTAMP '2024-01-16'")},
    pairs AS (
      SELECT coalesce(o.id, n.id) AS id, o.id IS NULL AS appears, n.id IS NULL AS vanishes,
        o.name AS old_name, o.props AS old_props, n.name AS new_name, n.props AS new_props
      FROM present o FULL OUTER JOIN past n ON o.id = n.id),
    kinds AS (
      SELECT id, new_name AS name, new_props AS props, 'insert' AS _change_type FROM pairs WHERE appears
      UNION ALL SELECT id, old_name, old_props, 'delete' FROM pairs WHERE vanishes
      UNION ALL SELECT id, old_name, old_props, 'update_preimage' FROM pairs
        WHERE NOT appears AND NOT vanishes AND (old_name, old_props) IS DISTINCT FROM (new_name, new_props)
      UNION ALL SELECT id, new_name, new_props, 'update_postimage' FROM pairs
        WHERE NOT appears AND NOT vanishes AND (old_name, old_props) IS DISTINCT FROM (new_name, new_props))
    SELECT *, CAST(1000000000 AS BIGINT) AS _commit_version, TIMESTAMP '2024-02-01' AS _commit_timestamp FROM kinds"""
)
def restore_version(t: Tables) -> DataFrame:
    """The changes that bring back the middle of the month."""
    return changes.restore(inputs.change_log(t), ["id"], inputs.MIDDLE, 1_000_000_000, CHANGE_TIME)


_LATEST = f"""{inputs.CDC}, newest AS (
  SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY "sequenceNum" DESC) AS rn FROM cdc)"""


@query(f"""WITH {_LATEST} SELECT "userId", name, city FROM newest WHERE rn = 1 AND operation <> 'DELETE'""")
def cdc_scd1(t: Tables) -> DataFrame:
    return cdc.cdc_scd1(inputs.cdc_events(t), ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)


def with_truncates(t: Tables) -> DataFrame:
    """Expensive signups stand for truncates of the whole table."""
    e = t.events.select(F.col("event_id").alias("sequenceNum"), "value")
    events = inputs.cdc_events(t).join(e, "sequenceNum")
    truncates = (F.col("operation") == "INSERT") & (F.col("value") > 100)
    return events.withColumn("operation", F.when(truncates, F.lit("TRUNCATE")).otherwise(F.col("operation"))).drop("value")


CDC_TRUNCATE_SQL = """WITH cdc AS (
      SELECT user_id AS "userId", event_type AS name,
        CASE WHEN event_id % 5 <> 0 THEN 'c' || (event_id % 7) END AS city, event_id AS "sequenceNum",
        CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'signup' AND value > 100 THEN 'TRUNCATE'
             WHEN event_type = 'signup' THEN 'INSERT' ELSE 'UPDATE' END AS operation
      FROM events),
    alive AS (
      SELECT * FROM cdc WHERE "sequenceNum" > coalesce(
        (SELECT max("sequenceNum") FROM cdc WHERE operation = 'TRUNCATE'), -1)),
    newest AS (SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY "sequenceNum" DESC) AS rn FROM alive)
    SELECT "userId", name, city FROM newest WHERE rn = 1 AND operation <> 'DELETE'"""


@query(CDC_TRUNCATE_SQL)
def cdc_scd1_truncate(t: Tables) -> DataFrame:
    return cdc.cdc_scd1(
        with_truncates(t),
        ["userId"],
        "sequenceNum",
        IS_DELETE,
        truncate_when="operation = 'TRUNCATE'",
        except_cols=TECHNICAL,
    )


@query(
    f"""WITH {inputs.CDC},
    ends AS (SELECT "userId", max("sequenceNum") FILTER (WHERE operation = 'DELETE') AS ended,
               max("sequenceNum") FILTER (WHERE operation <> 'DELETE') AS written FROM cdc GROUP BY "userId"),
    life AS (SELECT c.* FROM cdc c JOIN ends e ON c."userId" = e."userId"
             WHERE operation <> 'DELETE' AND "sequenceNum" > coalesce(ended, -1))
    SELECT "userId", arg_max(name, "sequenceNum") AS name, arg_max(city, "sequenceNum") AS city
    FROM life GROUP BY "userId" """
)
def cdc_scd1_ignore_nulls(t: Tables) -> DataFrame:
    return cdc.cdc_scd1(
        inputs.cdc_events(t), ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL, ignore_nulls=True
    )


def history_sql(tracked: list[str], rest: list[str], source: str = "cdc") -> str:
    """Runs of equal tracked columns, by gaps and islands, from rows named like CDC events."""
    changed = " OR ".join(f"p_{c} IS DISTINCT FROM {c}" for c in tracked)
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked)
    firsts = "".join(f", arg_min_null({c}, \"sequenceNum\") AS {c}" for c in tracked)
    lasts = "".join(f", arg_max_null({c}, \"sequenceNum\") AS {c}" for c in rest)
    return f"""steps AS (
      SELECT *, operation = 'DELETE' AS gone, lag(operation) OVER w AS p_operation, {lags}
      FROM {source} WINDOW w AS (PARTITION BY "userId" ORDER BY "sequenceNum")),
    flagged AS (
      SELECT *, CASE WHEN gone OR p_operation IS NULL OR p_operation = 'DELETE' OR {changed} THEN 1 ELSE 0 END AS edge
      FROM steps),
    numbered AS (SELECT *, sum(edge) OVER (PARTITION BY "userId" ORDER BY "sequenceNum") AS run FROM flagged),
    runs AS (
      SELECT "userId", run, bool_or(gone) AS gone, min("sequenceNum") AS "__START_AT"{firsts}{lasts}
      FROM numbered GROUP BY "userId", run),
    history AS (
      SELECT *, lead("__START_AT") OVER (PARTITION BY "userId" ORDER BY run) AS "__END_AT" FROM runs)"""


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])}
    SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history WHERE NOT gone"""
)
def cdc_scd2(t: Tables) -> DataFrame:
    """History of users: every change of a column starts a row, a delete ends one."""
    return cdc.cdc_scd2(inputs.cdc_events(t), ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name"], ["city"])}
    SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history WHERE NOT gone"""
)
def cdc_scd2_track(t: Tables) -> DataFrame:
    """Only changes of the name make history; the city is updated in place."""
    return cdc.cdc_scd2(
        inputs.cdc_events(t), ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL, track_except=["city"]
    )


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])},
    days AS (SELECT event_id, CAST(ts AS DATE) AS day FROM events)
    SELECT h."userId", h.name, h.city, s.day AS start_day, h."__START_AT" AS start_id, e.day AS end_day,
      h."__END_AT" AS end_id
    FROM history h JOIN days s ON s.event_id = h."__START_AT" LEFT JOIN days e ON e.event_id = h."__END_AT"
    WHERE NOT h.gone"""
)
def cdc_seq_struct(t: Tables) -> DataFrame:
    """A day and an id together are the sequence; both bounds are structs of the two."""
    days = t.events.select(F.col("event_id").alias("sequenceNum"), F.to_date("ts").alias("day"))
    events = inputs.cdc_events(t).join(days, "sequenceNum").withColumnRenamed("sequenceNum", "id")
    history = cdc.cdc_scd2(events, ["userId"], ["day", "id"], IS_DELETE, except_cols=["operation", "day", "id"])
    return history.select(
        "userId",
        "name",
        "city",
        F.col("__START_AT.day").alias("start_day"),
        F.col("__START_AT.id").alias("start_id"),
        F.col("__END_AT.day").alias("end_day"),
        F.col("__END_AT.id").alias("end_id"),
    )


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])}
    SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history WHERE NOT gone"""
)
def cdc_out_of_order(t: Tables) -> DataFrame:
    """Purchases arrive after everything else; the users they touch are rebuilt from the log."""
    log = inputs.cdc_events(t)
    late = log.filter(F.col("name") == "purchase")
    early = log.filter(F.col("name") != "purchase")

    def rebuild(events: DataFrame) -> DataFrame:
        return cdc.cdc_scd2(events, ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)

    return cdc.cdc_refresh(rebuild(early), log, late, ["userId"], rebuild)


@query(
    """SELECT user_id AS "userId", 'ambiguous_sequence' AS violation, CAST(sum(n) AS BIGINT) AS events FROM (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY ALL
      HAVING count(DISTINCT event_id) > 1) GROUP BY user_id
    UNION ALL
    SELECT user_id, 'null_sequence', count(*) FROM events WHERE event_type = 'view' GROUP BY user_id
    UNION ALL
    SELECT user_id, 'truncate_in_history', count(*) FROM events WHERE event_type = 'signup' GROUP BY user_id"""
)
def cdc_validate(t: Tables) -> DataFrame:
    """A day is too coarse a sequence, views lack one, and signups claim to be truncates."""
    events = t.events.select(
        F.col("user_id").alias("userId"),
        "event_id",
        "event_type",
        F.when(F.col("event_type") != "view", F.to_date("ts")).alias("day"),
    )
    return cdc.cdc_validate(events, ["userId"], "day", scd_type=2, truncate_when="event_type = 'signup'")


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])},
    middle AS (SELECT max("sequenceNum") // 2 AS point FROM cdc)
    SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history, middle
    WHERE NOT gone AND "__START_AT" <= point AND ("__END_AT" IS NULL OR point < "__END_AT")"""
)
def scd2_as_of(t: Tables) -> DataFrame:
    """The dimension as it was half way through the events."""
    events = inputs.cdc_events(t)
    history = cdc.cdc_scd2(events, ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)
    middle = events.agg(F.expr("max(sequenceNum) div 2")).scalar()
    return scd.scd2_as_of(history, middle, cdc.START, cdc.END)


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])},
    opened AS (SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history WHERE NOT gone),
    added AS (
      SELECT * FROM opened
      UNION ALL SELECT c_custkey, c_name, 'Oaxaca', CAST(5 AS BIGINT), NULL FROM customer),
    looked AS (
      SELECT *, lead("__START_AT") OVER (PARTITION BY "userId" ORDER BY "__START_AT", "__END_AT" NULLS FIRST) AS next_start
      FROM added)
    SELECT * FROM looked WHERE next_start IS NOT NULL AND ("__END_AT" IS NULL OR "__END_AT" > next_start)"""
)
def manual_history_row(t: Tables) -> DataFrame:
    """Rows with explicit bounds are put into a history; the report shows those that overlap."""
    history = cdc.cdc_scd2(inputs.cdc_events(t), ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)
    manual = t.customer.select(
        F.col("c_custkey").alias("userId"),
        F.col("c_name").alias("name"),
        F.lit("Oaxaca").alias("city"),
        F.lit(5).cast("bigint").alias(cdc.START),
        F.lit(None).cast("bigint").alias(cdc.END),
    )
    return scd.scd2_overlaps(history.unionByName(manual), ["userId"], cdc.START, cdc.END)


def _staging(snapshot: DataFrame, limit: float) -> DataFrame:
    """Two attributes from a snapshot; the second says who has more than ``limit``."""
    rich = F.when(F.col("c_acctbal") > limit, F.lit("+")).otherwise(F.lit("-"))
    return snapshot.select(
        F.col("c_custkey").alias("business_key"),
        F.col("c_name").alias("attr1"),
        F.concat(F.coalesce(F.col("c_mktsegment"), F.lit("?")), rich).alias("attr2"),
    )


_STAGED = """SELECT c_custkey AS business_key, c_name AS attr1,
        coalesce(c_mktsegment, '?') || CASE WHEN c_acctbal > {limit} THEN '+' ELSE '-' END AS attr2 FROM {table}"""


@query(
    f"""WITH {_SNAPSHOTS},
    s1 AS (SELECT *, {row_hash_sql("business_key", "attr1", "attr2")} AS record_hash
           FROM ({_STAGED.format(limit=5000, table="old")})),
    s2 AS (SELECT *, {row_hash_sql("business_key", "attr1", "attr2")} AS record_hash
           FROM ({_STAGED.format(limit=4000, table="new")})),
    pairs AS (SELECT s1.*, s2.business_key IS NOT NULL AND s2.record_hash <> s1.record_hash AS closed
              FROM s1 LEFT JOIN s2 ON s1.business_key = s2.business_key)
    SELECT business_key, attr1, attr2, TIMESTAMP '2024-01-01' AS effective_start,
      CASE WHEN closed THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2999-12-31' END AS effective_end,
      NOT closed AS is_current, record_hash FROM pairs
    UNION ALL
    SELECT s2.business_key, s2.attr1, s2.attr2, TIMESTAMP '2024-02-01', TIMESTAMP '2999-12-31', TRUE, s2.record_hash
    FROM s2 LEFT JOIN s1 ON s1.business_key = s2.business_key
    WHERE s1.business_key IS NULL OR s1.record_hash <> s2.record_hash"""
)
def scd2_hash(t: Tables) -> DataFrame:
    """Two loads: the second closes what changed, opens it anew, and adds new keys."""
    keys, attrs = ["business_key"], ["attr1", "attr2"]
    first, second = _staging(_customer_snapshot(t), 5000), _staging(_later_snapshot(t), 4000)
    dim = scd.scd2_hash(scd.empty_dimension(first, keys, attrs), first, keys, attrs, LOAD_TIMES[0])
    return scd.scd2_hash(dim, second, keys, attrs, LOAD_TIMES[1])
