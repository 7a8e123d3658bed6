"""Run diagnosis over event logs rendered from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.diagnosis import eventlog, reports
from tablewright.plans.registry import query
from tablewright.sources.tables import Tables


def _number(text: str) -> Column:
    return F.expr(f"CAST({text} AS BIGINT)")


def _lines(rows: DataFrame, app: Column, event: str, *fields: Column) -> DataFrame:
    """Rows as event-log lines of an application: ``app``, ``event``, ``value``."""
    value = F.to_json(F.struct(F.lit(event).alias("Event"), *fields))
    return rows.select(app.alias("app"), F.lit(event).alias("event"), value.alias("value"))


def task_log(t: Tables) -> DataFrame:
    """Each order line as a finished task: the supplier is its stage, the line number its executor."""
    launch = F.unix_millis(F.col("l_shipdate").cast("timestamp")) + F.col("l_partkey")
    run, load = _number("l_quantity * 1000"), _number("l_linenumber * 20")
    level = F.when(F.col("l_linestatus") == "O", F.lit("PROCESS_LOCAL")).otherwise(F.lit("ANY"))
    failed, killed = F.col("l_returnflag") == "R", F.col("l_returnflag") == "N"
    info = F.struct(
        F.col("l_orderkey").alias("Task ID"),
        F.lit(0).alias("Index"),
        F.when(failed, F.lit(1)).otherwise(F.lit(0)).alias("Attempt"),
        launch.alias("Launch Time"),
        F.col("l_linenumber").cast("string").alias("Executor ID"),
        level.alias("Locality"),
        F.lit(False).alias("Speculative"),
        F.lit(0).cast("bigint").alias("Getting Result Time"),
        (launch + run + load + 100).alias("Finish Time"),
        failed.alias("Failed"),
        killed.alias("Killed"),
    )
    metrics = F.struct(
        load.alias("Executor Deserialize Time"),
        run.alias("Executor Run Time"),
        _number("round(l_discount * 10000)").alias("JVM GC Time"),
        F.lit(10).cast("bigint").alias("Result Serialization Time"),
        _number("l_partkey * 1024").alias("Peak Execution Memory"),
        _number("CASE WHEN l_quantity > 45 THEN l_partkey ELSE 0 END").alias("Memory Bytes Spilled"),
        _number("CASE WHEN l_quantity > 48 THEN l_partkey ELSE 0 END").alias("Disk Bytes Spilled"),
        F.struct(
            _number("round(l_tax * 10000)").alias("Fetch Wait Time"),
            F.col("l_partkey").alias("Remote Bytes Read"),
            F.col("l_orderkey").alias("Local Bytes Read"),
        ).alias("Shuffle Read Metrics"),
        F.struct(
            F.col("l_orderkey").alias("Shuffle Bytes Written"),
            _number("l_quantity * 3000000").alias("Shuffle Write Time"),
        ).alias("Shuffle Write Metrics"),
        F.struct(F.col("l_partkey").alias("Bytes Read"), F.col("l_orderkey").alias("Records Read")).alias("Input Metrics"),
    )
    reason = F.when(failed, F.lit("ExceptionFailure")).when(killed, F.lit("TaskKilled")).otherwise(F.lit("Success"))
    return _lines(
        t.lineitem,
        F.concat(F.lit("app-"), F.col("l_linestatus")),
        eventlog.TASK_END,
        F.col("l_suppkey").alias("Stage ID"),
        F.lit(0).alias("Stage Attempt ID"),
        F.struct(reason.alias("Reason")).alias("Task End Reason"),
        info.alias("Task Info"),
        metrics.alias("Task Metrics"),
    )


TASKS = """tasks AS (
  SELECT 'app-' || l_linestatus AS app, l_suppkey AS stage_id, 0 AS stage_attempt, l_orderkey AS task_id,
    CAST(l_linenumber AS VARCHAR) AS executor_id,
    CASE WHEN l_linestatus = 'O' THEN 'PROCESS_LOCAL' ELSE 'ANY' END AS locality,
    l_returnflag = 'R' AS failed, l_returnflag = 'N' AS killed,
    epoch_ms(l_shipdate) + l_partkey AS launch_time,
    epoch_ms(l_shipdate) + l_partkey + CAST(l_quantity * 1000 AS BIGINT) + l_linenumber * 20 + 100 AS finish_time,
    CAST(l_quantity * 1000 AS BIGINT) + l_linenumber * 20 + 100 AS duration,
    CAST(l_quantity * 1000 AS BIGINT) AS run_time, l_linenumber * 20 AS deserialize_time, 10 AS serialize_time,
    90 AS scheduler_delay, CAST(round(l_discount * 10000) AS BIGINT) AS gc_time,
    CAST(round(l_tax * 10000) AS BIGINT) AS fetch_wait, l_partkey * 1024 AS peak_memory,
    CASE WHEN l_quantity > 45 THEN l_partkey ELSE 0 END AS memory_spilled,
    CASE WHEN l_quantity > 48 THEN l_partkey ELSE 0 END AS disk_spilled,
    l_partkey + l_orderkey AS shuffle_read, l_orderkey AS shuffle_written,
    CAST(l_quantity * 3 AS BIGINT) AS shuffle_write_time, l_partkey AS input_bytes
  FROM lineitem)"""


def tasks(t: Tables, *columns: str) -> DataFrame:
    return eventlog.tasks(task_log(t), ["stage_id", "stage_attempt", *columns])


@query(
    f"""WITH {TASKS} SELECT app, stage_id, task_id, executor_id, locality, failed, killed, launch_time, finish_time, duration,
      run_time, deserialize_time, serialize_time, scheduler_delay, gc_time, fetch_wait, peak_memory, memory_spilled,
      disk_spilled, shuffle_read, shuffle_written, shuffle_write_time, input_bytes FROM tasks"""
)
def log_tasks(t: Tables) -> DataFrame:
    """Finished tasks of all applications as a typed table."""
    return eventlog.tasks(task_log(t)).select(
        "app", "stage_id", "task_id", "executor_id", "locality", "failed", "killed", "launch_time", "finish_time",
        "duration", "run_time", "deserialize_time", "serialize_time", "scheduler_delay", "gc_time", "fetch_wait",
        "peak_memory", "memory_spilled", "disk_spilled", "shuffle_read", "shuffle_written", "shuffle_write_time",
        "input_bytes",
    )


@query(
    f"""WITH {TASKS}, p AS (
      SELECT app, stage_id, count(*) AS num_tasks, quantile_disc(duration, 0.5) AS p50, quantile_disc(duration, 0.95) AS p95,
        quantile_disc(duration, 0.99) AS p99, max(duration) AS max_time FROM tasks GROUP BY ALL)
    SELECT *, max_time / p50 AS max_to_median,
      CASE WHEN max_time / p50 > 5 THEN 'SKEWED' WHEN max_time / p50 > 3 THEN 'WARN' ELSE 'OK' END AS verdict FROM p"""
)
def log_stage_skew(t: Tables) -> DataFrame:
    return reports.stage_skew(tasks(t, "duration")).drop("stage_attempt")


@query(
    f"""WITH {TASKS} SELECT app, stage_id, CAST(sum(shuffle_read) AS BIGINT) AS read_bytes,
      max(shuffle_read) AS max_read_bytes, CAST(sum(shuffle_written) AS BIGINT) AS written_bytes,
      CAST(sum(shuffle_write_time) AS BIGINT) AS write_time, CAST(sum(fetch_wait) AS BIGINT) AS fetch_wait,
      CAST(sum(fetch_wait) AS BIGINT) / CAST(sum(duration) AS BIGINT) AS wait_share,
      CAST(sum(fetch_wait) AS BIGINT) / CAST(sum(duration) AS BIGINT) >= 0.1 AS slow_fetch FROM tasks GROUP BY ALL"""
)
def log_shuffle(t: Tables) -> DataFrame:
    return reports.shuffle_report(tasks(t, "shuffle_read", "shuffle_written", "shuffle_write_time", "fetch_wait", "duration")).drop("stage_attempt")


@query(
    f"""WITH {TASKS},
    g AS (SELECT app, 'stage' AS level, CAST(stage_id AS VARCHAR) AS name, CAST(sum(gc_time) AS BIGINT) AS gc_time,
            CAST(sum(run_time) AS BIGINT) AS run_time FROM tasks GROUP BY ALL
          UNION ALL SELECT app, 'executor', executor_id, CAST(sum(gc_time) AS BIGINT), CAST(sum(run_time) AS BIGINT)
          FROM tasks GROUP BY ALL)
    SELECT *, gc_time / run_time AS gc_share, gc_time / run_time >= 0.1 AS memory_pressure FROM g"""
)
def log_gc(t: Tables) -> DataFrame:
    """Garbage collection by stage and by executor; the events are parsed once for both."""
    rows = tasks(t, "executor_id", "gc_time", "run_time")
    sums = [F.sum(c).alias(c) for c in ("gc_time", "run_time")]
    rows = rows.groupBy(*reports.STAGE, "executor_id").agg(*sums)

    def named(report: DataFrame, level: str, name: str) -> DataFrame:
        return report.select(
            "app", F.lit(level).alias("level"), F.col(name).cast("string").alias("name"), "gc_time", "run_time", "gc_share",
            "memory_pressure",
        )

    by_stage = named(reports.gc_report(rows), "stage", "stage_id")
    return by_stage.unionByName(named(reports.gc_report(rows, ["app", "executor_id"]), "executor", "executor_id"))


@query(
    f"""WITH {TASKS}, s AS (SELECT app, stage_id, CAST(sum(scheduler_delay) AS BIGINT) AS a, CAST(sum(deserialize_time) AS BIGINT) AS b,
      CAST(sum(serialize_time) AS BIGINT) AS c, CAST(sum(duration) AS BIGINT) AS d FROM tasks GROUP BY ALL)
    SELECT app, stage_id, a / d AS scheduler_share, b / d AS deserialize_share, c / d AS serialize_share,
      CAST(0 AS DOUBLE) AS result_share, greatest(a, b, c) / d >= 0.05 AS too_high FROM s"""
)
def log_overhead(t: Tables) -> DataFrame:
    return reports.overhead_report(tasks(t, "scheduler_delay", "deserialize_time", "serialize_time", "getting_result", "duration")).drop("stage_attempt")


def executor_log(t: Tables) -> DataFrame:
    """One executor per line number and application; those with even numbers are lost later on."""
    seen = t.lineitem.groupBy("l_linestatus", "l_linenumber").agg(F.min("l_shipdate").alias("since"))
    app = F.concat(F.lit("app-"), F.col("l_linestatus"))
    number = F.col("l_linenumber").cast("string").alias("Executor ID")
    start = F.unix_millis(F.col("since").cast("timestamp"))
    cores = F.struct(F.lit("host").alias("Host"), F.lit(4).alias("Total Cores")).alias("Executor Info")
    added = _lines(seen, app, eventlog.EXECUTOR_ADDED, start.alias("Timestamp"), number, cores)
    lost = seen.filter(F.col("l_linenumber") % 2 == 0)
    removed = _lines(
        lost, app, eventlog.EXECUTOR_REMOVED, (start + 1000).alias("Timestamp"), number,
        F.lit("worker lost").alias("Removed Reason"),
    )
    return added.unionByName(removed)


@query(
    f"""WITH {TASKS}, lost AS (
      SELECT 'app-' || l_linestatus AS app, count(DISTINCT l_linenumber) FILTER (WHERE l_linenumber % 2 = 0) AS lost_executors
      FROM lineitem GROUP BY ALL)
    SELECT t.app, stage_id, count(*) AS attempts, count(*) FILTER (WHERE failed) AS failed,
      count(*) FILTER (WHERE killed) AS killed, count(*) FILTER (WHERE failed) AS retried, any_value(lost_executors) AS lost_executors
    FROM tasks t JOIN lost l ON t.app = l.app GROUP BY t.app, stage_id"""
)
def log_failures(t: Tables) -> DataFrame:
    """Failed, killed and repeated tasks, and lost executors."""
    report = reports.failure_report(tasks(t, "failed", "killed", "attempt"), eventlog.executors(executor_log(t)))
    return report.drop("stage_attempt")


@query(
    f"""WITH {TASKS}, spans AS (
      SELECT app, executor_id, launch_time, finish_time,
        unnest(range(launch_time // 60000, (finish_time - 1) // 60000 + 1)) AS bucket FROM tasks)
    SELECT app, executor_id, bucket * 60000 AS bucket_start,
      CAST(sum(least(finish_time, (bucket + 1) * 60000) - greatest(launch_time, bucket * 60000)) AS BIGINT) AS busy_ms,
      CAST(sum(least(finish_time, (bucket + 1) * 60000) - greatest(launch_time, bucket * 60000)) AS BIGINT) / 60000 / 4 AS busy_share
    FROM spans GROUP BY ALL"""
)
def log_utilization(t: Tables) -> DataFrame:
    """Busy milliseconds per executor and minute, and the share of its cores."""
    used = reports.utilization(tasks(t, "executor_id", "launch_time", "finish_time"), eventlog.executors(executor_log(t)))
    return used.select("app", "executor_id", "bucket_start", "busy_ms", "busy_share")


@query(
    f"""WITH {TASKS} SELECT app, stage_id, CAST(sum(memory_spilled) AS BIGINT) AS memory_spilled,
      CAST(sum(disk_spilled) AS BIGINT) AS disk_spilled, max(peak_memory) AS peak_memory,
      sum(memory_spilled) > 0 OR sum(disk_spilled) > 0 AS spills FROM tasks GROUP BY ALL"""
)
def log_spill_memory(t: Tables) -> DataFrame:
    return reports.spill_report(tasks(t, "memory_spilled", "disk_spilled", "peak_memory")).drop("stage_attempt")


@query(
    f"""WITH {TASKS}, c AS (SELECT app, locality, count(*) AS num_tasks FROM tasks GROUP BY ALL)
    SELECT *, num_tasks / CAST(sum(num_tasks) OVER (PARTITION BY app) AS BIGINT) AS share FROM c"""
)
def log_locality(t: Tables) -> DataFrame:
    return reports.locality_report(tasks(t, "locality"))


@query(
    f"""WITH {TASKS} SELECT app, executor_id, count(*) AS num_tasks, CAST(sum(input_bytes) AS BIGINT) AS input_bytes,
      CAST(sum(shuffle_read) AS BIGINT) AS shuffle_read, CAST(sum(shuffle_written) AS BIGINT) AS shuffle_written,
      round(sum(input_bytes + shuffle_read) / avg(sum(input_bytes + shuffle_read)) OVER (PARTITION BY app), 6) AS to_average
    FROM tasks GROUP BY app, executor_id"""
)
def log_executor_balance(t: Tables) -> DataFrame:
    return reports.executor_balance(tasks(t, "executor_id", "input_bytes", "shuffle_read", "shuffle_written")).withColumn("to_average", F.round("to_average", 6))


def job_log(t: Tables) -> DataFrame:
    """Each order as a job of the application its priority names, lasting one second per stage."""
    app = F.concat(F.lit("app-"), F.substring("o_orderpriority", 1, 1))
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    ids = F.sequence(F.lit(1).cast("bigint"), F.col("o_custkey") % 5 + 1)
    started = _lines(
        t.orders,
        app,
        eventlog.JOB_START,
        F.col("o_orderkey").alias("Job ID"),
        start.alias("Submission Time"),
        ids.alias("Stage IDs"),
        F.create_map(F.lit("spark.sql.execution.id"), F.col("o_custkey").cast("string")).alias("Properties"),
    )
    result = F.when(F.col("o_orderstatus") == "F", F.lit("JobFailed")).otherwise(F.lit("JobSucceeded"))
    ended = _lines(
        t.orders,
        app,
        eventlog.JOB_END,
        F.col("o_orderkey").alias("Job ID"),
        (start + F.size(ids) * 1000).alias("Completion Time"),
        F.struct(result.alias("Result")).alias("Job Result"),
    )
    return started.unionByName(ended)


@query(
    """WITH jobs AS (
      SELECT 'app-' || o_orderpriority[1] AS app, o_orderkey AS job_id, epoch_ms(o_orderdate) + o_orderkey AS submitted,
        o_custkey % 5 + 1 AS num_stages, o_orderstatus <> 'F' AS succeeded FROM orders),
    ends AS (SELECT *, submitted + num_stages * 1000 AS completed FROM jobs)
    SELECT app, job_id, num_stages * 1000 AS duration, num_stages,
      CASE WHEN lag(completed) OVER w IS NOT NULL THEN greatest(submitted - lag(completed) OVER w, 0) END AS idle_before,
      succeeded FROM ends WINDOW w AS (PARTITION BY app ORDER BY submitted, job_id)"""
)
def log_jobs_stages(t: Tables) -> DataFrame:
    """Jobs with their durations, stages and the idle time before them."""
    return reports.job_report(eventlog.jobs(job_log(t)))


def sql_log(t: Tables) -> DataFrame:
    """Each order as a SQL execution that scans and sorts, and each of its lines as a task of it."""
    app = F.concat(F.lit("app-"), F.substring("o_orderpriority", 1, 1))

    def node(name: str, metric: str, kind: str, number, children: str) -> Column:
        metrics = F.array(
            F.struct(F.lit(metric).alias("name"), number.alias("accumulatorId"), F.lit(kind).alias("metricType"))
        )
        child = F.array() if children == "" else F.array(F.col(children))
        return F.struct(F.lit(name).alias("nodeName"), F.lit(name).alias("simpleString"), child.alias("children"), metrics.alias("metrics"))

    key = F.col("o_orderkey")
    plans = t.orders.withColumn("leaf", node("Scan parquet", "number of output rows", "sum", key * 2, ""))
    started = _lines(
        plans,
        app,
        eventlog.SQL_START,
        key.alias("executionId"),
        node("Sort", "sort time", "timing", key * 2 + 1, "leaf").alias("sparkPlanInfo"),
    )
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == key)

    def update(number, value) -> Column:
        return F.struct(number.alias("ID"), value.cast("string").alias("Update"), F.lit("sql").alias("Metadata"))

    accumulated = F.array(update(key * 2, F.col("l_partkey")), update(key * 2 + 1, F.expr("CAST(l_quantity AS BIGINT)")))
    ended = _lines(
        lines,
        app,
        eventlog.TASK_END,
        F.col("l_suppkey").alias("Stage ID"),
        F.struct(accumulated.alias("Accumulables")).alias("Task Info"),
    )
    return started.unionByName(ended)


@query(
    """WITH joined AS (
      SELECT 'app-' || o_orderpriority[1] AS app, o_orderkey AS execution_id, l_partkey, CAST(l_quantity AS BIGINT) AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT app, execution_id, 'Scan parquet' AS node, 'number of output rows' AS metric, 'sum' AS metric_type,
      CAST(sum(l_partkey) AS BIGINT) AS total, max(l_partkey) AS largest FROM joined GROUP BY ALL
    UNION ALL
    SELECT app, execution_id, 'Sort', 'sort time', 'timing', CAST(sum(q) AS BIGINT), max(q) FROM joined GROUP BY ALL"""
)
def log_sql_operators(t: Tables) -> DataFrame:
    """Rows and times per operator of each SQL execution."""
    return reports.sql_operators(sql_log(t))


@query(
    """SELECT 'app-' || c_custkey AS app, s.setting,
      CASE WHEN s.setting = 'spark.sql.adaptive.enabled' THEN CASE WHEN c_acctbal < 0 THEN 'false' ELSE 'true' END
           WHEN s.setting = 'spark.sql.shuffle.partitions' THEN CAST(c_nationkey * 8 AS VARCHAR) ELSE s.value END AS value,
      s.setting IN ('spark.sql.adaptive.enabled', 'spark.sql.shuffle.partitions') AS is_set,
      CASE WHEN s.setting = 'spark.sql.adaptive.enabled' AND c_acctbal < 0 THEN 'TURN_ON' ELSE 'OK' END AS verdict
    FROM customer, (VALUES ('spark.sql.adaptive.enabled', 'true'), ('spark.sql.adaptive.coalescePartitions.enabled', 'true'),
      ('spark.sql.adaptive.skewJoin.enabled', 'true'), ('spark.sql.shuffle.partitions', '200'),
      ('spark.sql.autoBroadcastJoinThreshold', '10485760b')) s(setting, value)"""
)
def log_config_check(t: Tables) -> DataFrame:
    """Each customer as an application with two settings of its own."""
    adaptive = F.when(F.col("c_acctbal") < 0, F.lit("false")).otherwise(F.lit("true"))
    settings = F.create_map(
        F.lit("spark.sql.adaptive.enabled"), adaptive,
        F.lit("spark.sql.shuffle.partitions"), (F.col("c_nationkey") * 8).cast("string"),
    )
    log = _lines(
        t.customer,
        F.concat(F.lit("app-"), F.col("c_custkey").cast("string")),
        eventlog.ENVIRONMENT,
        settings.alias("Spark Properties"),
    )
    return reports.config_check(eventlog.properties(log))


@query(
    """SELECT 'app-' || event_type AS app, CAST(user_id AS VARCHAR) AS query_id, count(*) AS batches,
      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS input_rows, max(user_id + event_id % 1000) AS max_duration,
      CAST(sum(user_id + event_id % 1000) AS BIGINT) AS total_duration FROM events GROUP BY event_type, user_id"""
)
def log_stream_progress(t: Tables) -> DataFrame:
    """Each event as a finished micro-batch of its user's streaming query."""
    progress = F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("batchId"),
        _number("round(value * 100)").alias("numInputRows"),
        F.create_map(F.lit("triggerExecution"), F.col("user_id") + F.col("event_id") % 1000).alias("durationMs"),
    )
    app = F.concat(F.lit("app-"), F.col("event_type"))
    log = _lines(t.events, app, eventlog.STREAM_PROGRESS, progress.alias("progress"))
    return reports.stream_health(eventlog.stream_progress(log))


@query(
    f"""WITH {TASKS},
    stages AS (
      SELECT app, stage_id, CAST(sum(duration) AS BIGINT) AS task_time, max(duration) / quantile_disc(duration, 0.5) / 3 AS skew,
        CAST(sum(memory_spilled) + sum(disk_spilled) AS BIGINT) AS spilled, count(*) FILTER (WHERE failed) AS failed,
        CAST(sum(fetch_wait) AS BIGINT) / CAST(sum(duration) AS BIGINT) / 0.1 AS waits,
        CAST(sum(gc_time) AS BIGINT) / CAST(sum(run_time) AS BIGINT) / 0.1 AS gc,
        CAST(sum(scheduler_delay + deserialize_time + serialize_time) AS BIGINT) / CAST(sum(duration) AS BIGINT) / 0.05 AS overhead
      FROM tasks GROUP BY app, stage_id),
    found AS (
      SELECT app, stage_id, task_time, 'skew' AS cause, skew AS severity FROM stages
      UNION ALL SELECT app, stage_id, task_time, 'spill', CASE WHEN spilled > 0 THEN 2.0 ELSE 0.0 END FROM stages
      UNION ALL SELECT app, stage_id, task_time, 'fetch_wait', waits FROM stages
      UNION ALL SELECT app, stage_id, task_time, 'gc', gc FROM stages
      UNION ALL SELECT app, stage_id, task_time, 'overhead', overhead FROM stages
      UNION ALL SELECT app, stage_id, task_time, 'failures', CASE WHEN failed > 0 THEN 2.0 ELSE 0.0 END FROM stages)
    SELECT app, stage_id, task_time, cause, round(severity, 6) AS severity,
      row_number() OVER (PARTITION BY app ORDER BY task_time DESC, severity DESC, stage_id, cause) AS position
    FROM found WHERE severity > 1"""
)
def log_triage(t: Tables) -> DataFrame:
    """Findings ranked by the task time they concern."""
    ranked = reports.triage(tasks(t, "duration", "memory_spilled", "disk_spilled", "failed", "fetch_wait", "gc_time", "run_time", "scheduler_delay", "deserialize_time", "serialize_time"))
    return ranked.select("app", "stage_id", "task_time", "cause", F.round("severity", 6).alias("severity"), "position")
