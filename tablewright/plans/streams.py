"""Streaming jobs, run over their backlog and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.operators import cdc
from tablewright.plans import inputs
from tablewright.plans.history import CDC_TRUNCATE_SQL, IS_DELETE, TECHNICAL, history_sql, with_truncates
from tablewright.plans.registry import query
from tablewright.session import scratch
from tablewright.sources.tables import Tables
from tablewright.streaming import feed, ingest, sinks
from tablewright.streaming.cdc_table import CdcTable

_LANDING_FILES = 4


def _event_json(t: Tables) -> DataFrame:
    fields = ["event_id", "user_id", "event_type", "value"]
    return t.events.select(
        *fields, F.to_json(F.struct(*fields, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))).alias("json")
    )


def _land(lines: DataFrame, path: str) -> str:
    lines.repartition(_LANDING_FILES).write.text(path)
    return path


def _run(t: Tables, source: str, mode: str, base: str, sink: str) -> None:
    """Ingest what is new below ``source``."""
    query = ingest.ingest_stream(t.spark, source, f"{base}/schema", f"{base}/checkpoint", sink, mode, files_per_batch=2)
    query.awaitTermination()


@query("SELECT event_id, user_id, event_type, value, ts FROM events")
def ingest_files(t: Tables) -> DataFrame:
    """Events as JSON files, ingested in several batches with inferred types; a rerun adds nothing."""
    base = scratch(t.spark, "ingest_files")
    source = _land(_event_json(t).select("json"), f"{base}/landing")
    for _ in range(2):
        _run(t, source, ingest.ADD, base, f"{base}/sink")
    rows = ingest.read_ingested(t.spark, f"{base}/sink")
    return rows.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(
    """SELECT
      CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
      CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS value,
      CASE event_type WHEN 'error' THEN '{"event_id":' || event_id || ',"event_ty'
           WHEN 'view' THEN '{"value":"n/a"}'
           WHEN 'purchase' THEN '{"coupon":"c' || user_id || '"}' END AS _rescued_data
    FROM events"""
)
def ingest_rescued(t: Tables) -> DataFrame:
    """Torn lines, values of the wrong type and unknown fields are kept aside."""
    base = scratch(t.spark, "ingest_rescued")
    known = t.events.select("event_id", "event_type", "value").schema
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_ty')))
        .when(kind == "view", F.to_json(F.struct("event_id", "event_type", F.lit("n/a").alias("value"))))
        .when(
            kind == "purchase",
            F.to_json(
                F.struct("event_id", "event_type", "value", F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("coupon"))
            ),
        )
        .otherwise(F.to_json(F.struct("event_id", "event_type", "value")))
    )
    source = _land(t.events.select(line.alias("line")), f"{base}/landing")
    # The schema of the first batch is fixed beforehand, so that nothing has to be inferred.
    stored = t.spark.createDataFrame([(known.json(),)], "value string")
    stored.coalesce(1).write.text(f"{base}/schema/{ingest.BATCH}=0")
    sink = f"{base}/sink"

    def write(lines: DataFrame, batch_id: int) -> None:
        ingest.ingest_batch(lines, batch_id + 1, sink, f"{base}/schema", ingest.RESCUE, ingest.RESCUED)

    stream = t.spark.readStream.format("text").load(source)
    sinks.for_each_batch(stream, write, f"{base}/checkpoint").awaitTermination()
    return ingest.read_ingested(t.spark, sink)


@query(
    """SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS coupon, CAST(NULL AS VARCHAR) AS rescued FROM events
      WHERE event_type <> 'purchase'
    UNION ALL
    SELECT event_id, event_type, 'c' || user_id, NULL FROM events WHERE event_type = 'purchase'"""
)
def ingest_evolve(t: Tables) -> DataFrame:
    """Purchases come in later files and bring a column of their own, which the table gains."""
    base = scratch(t.spark, "ingest_evolve")
    plain = t.events.filter(F.col("event_type") != "purchase")
    purchases = t.events.filter(F.col("event_type") == "purchase")
    coupon = F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("coupon")
    _land(plain.select(F.to_json(F.struct("event_id", "event_type"))), f"{base}/landing/first")
    _run(t, f"{base}/landing", ingest.ADD, base, f"{base}/sink")
    _land(purchases.select(F.to_json(F.struct("event_id", "event_type", coupon))), f"{base}/landing/second")
    _run(t, f"{base}/landing", ingest.ADD, base, f"{base}/sink")
    rows = ingest.read_ingested(t.spark, f"{base}/sink")
    return rows.select("event_id", "event_type", "coupon", F.col(ingest.RESCUED).alias("rescued"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_append(t: Tables) -> DataFrame:
    """A table streamed into another; the second run finds nothing new."""
    base = scratch(t.spark, "stream_append")
    t.events.select("event_id", "user_id", "event_type", "value").repartition(_LANDING_FILES).write.parquet(f"{base}/source")
    for _ in range(2):
        stream = feed.stream_table(t.spark, f"{base}/source", files_per_batch=2)
        sinks.append_stream(stream, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/sink")


@query(
    f"""WITH {inputs.CHANGE_LOG}
    SELECT * FROM log WHERE _commit_version > (SELECT max(_commit_version) // 2 FROM log)"""
)
def stream_change_feed(t: Tables) -> DataFrame:
    """The later half of a change log as a stream."""
    base = scratch(t.spark, "stream_change_feed")
    inputs.change_log(t).repartition(_LANDING_FILES).write.parquet(f"{base}/log")
    start = feed.latest_version(t.spark, f"{base}/log") // 2 + 1
    stream = feed.stream_changes(t.spark, f"{base}/log", start, files_per_batch=2)
    sinks.append_stream(stream, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/sink")


_MINUTE_LOG = """log AS (
  SELECT user_id AS id, event_type AS name,
    CASE event_type WHEN 'error' THEN 'delete' WHEN 'purchase' THEN 'update_postimage' ELSE 'insert' END AS _change_type,
    CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS _commit_version, ts AS _commit_timestamp
  FROM events)"""


@query(
    f"""WITH {_MINUTE_LOG}
    SELECT * FROM log WHERE _commit_version NOT IN (SELECT _commit_version FROM log WHERE _change_type <> 'insert')"""
)
def stream_inserts_only(t: Tables) -> DataFrame:
    """Commits that update or delete are skipped; a commit is what happened in one minute."""
    base = scratch(t.spark, "stream_inserts_only")
    kind = F.col("event_type")
    change = F.when(kind == "error", F.lit("delete")).when(kind == "purchase", F.lit("update_postimage"))
    log = t.events.select(
        F.col("user_id").alias("id"),
        kind.alias("name"),
        change.otherwise(F.lit("insert")).alias("_change_type"),
        F.unix_timestamp(F.date_trunc("minute", F.col("ts").cast("timestamp"))).alias("_commit_version"),
        F.col("ts").alias("_commit_timestamp"),
    )
    log.repartition(_LANDING_FILES).write.parquet(f"{base}/log")
    stream = feed.stream_changes(t.spark, f"{base}/log", files_per_batch=2)
    write = feed.inserts_only(f"{base}/log", feed.overwrite_batch(f"{base}/sink"))
    sinks.for_each_batch(stream, write, f"{base}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{base}/sink").drop("batch_id")


@query(
    """SELECT event_id AS unique_event_id,
      CASE WHEN event_type = 'error' THEN 'corrected' ELSE props END AS payload,
      CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 HOUR ELSE ts END AS event_timestamp FROM events"""
)
def stream_upsert(t: Tables) -> DataFrame:
    """Events first, in several batches; then corrections of errors, each delivered twice."""
    base = scratch(t.spark, "stream_upsert")
    keys = ["unique_event_id"]
    events = t.events.select(
        F.col("event_id").alias("unique_event_id"), F.col("props").alias("payload"), F.col("ts").alias("event_timestamp")
    )
    fixed = t.events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("unique_event_id"),
        F.lit("corrected").alias("payload"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("event_timestamp"),
    )
    early = fixed.withColumns({"payload": F.lit("draft"), "event_timestamp": F.col("event_timestamp") - F.expr("INTERVAL 1 HOUR")})
    for rows in (events, fixed.unionByName(early)):
        rows.repartition(_LANDING_FILES, "unique_event_id").write.mode("append").parquet(f"{base}/source")
        stream = feed.stream_table(t.spark, f"{base}/source", files_per_batch=2)
        write = sinks.upsert_sink(f"{base}/table", keys, ["-event_timestamp"])
        sinks.for_each_batch(stream, write, f"{base}/checkpoint").awaitTermination()
    return sinks.read_upserts(t.spark, f"{base}/table", keys)


@query(
    f"""WITH {inputs.CDC}, {history_sql(["name", "city"], [])}
    SELECT "userId", name, city, "__START_AT", "__END_AT" FROM history WHERE NOT gone"""
)
def stream_cdc(t: Tables) -> DataFrame:
    """History kept by a stream whose files hold the events in no order."""
    base = scratch(t.spark, "stream_cdc")
    inputs.cdc_events(t).repartition(_LANDING_FILES).write.parquet(f"{base}/source")

    def rebuild(events: DataFrame) -> DataFrame:
        return cdc.cdc_scd2(events, ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)

    stream = feed.stream_table(t.spark, f"{base}/source", files_per_batch=2)
    table = CdcTable(f"{base}/dim", ["userId"], rebuild)
    sinks.for_each_batch(stream, table.write, f"{base}/checkpoint").awaitTermination()
    return table.read(t.spark)


@query(CDC_TRUNCATE_SQL)
def stream_cdc_truncate(t: Tables) -> DataFrame:
    """Current users kept by a stream with truncates, which come before and after what they remove."""
    base = scratch(t.spark, "stream_cdc_truncate")
    with_truncates(t).repartition(_LANDING_FILES).write.parquet(f"{base}/source")

    def rebuild(events: DataFrame) -> DataFrame:
        return cdc.cdc_scd1(events, ["userId"], "sequenceNum", IS_DELETE, except_cols=TECHNICAL)

    stream = feed.stream_table(t.spark, f"{base}/source", files_per_batch=1)
    table = CdcTable(f"{base}/users", ["userId"], rebuild, "sequenceNum", "operation = 'TRUNCATE'", fold_every=2)
    sinks.for_each_batch(stream, table.write, f"{base}/checkpoint").awaitTermination()
    return table.read(t.spark)
