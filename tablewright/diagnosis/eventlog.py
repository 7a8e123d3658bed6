"""Event logs as tables: one line of JSON per event, read as text and parsed natively."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

# Event names as Spark writes them.
TASK_END = "SparkListenerTaskEnd"
STAGE_COMPLETED = "SparkListenerStageCompleted"
JOB_START = "SparkListenerJobStart"
JOB_END = "SparkListenerJobEnd"
EXECUTOR_ADDED = "SparkListenerExecutorAdded"
EXECUTOR_REMOVED = "SparkListenerExecutorRemoved"
ENVIRONMENT = "SparkListenerEnvironmentUpdate"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_ADAPTIVE = "org.apache.spark.sql.execution.ui.SparkListenerSQLAdaptiveExecutionUpdate"
SQL_DRIVER_METRICS = "org.apache.spark.sql.execution.ui.SparkListenerDriverAccumUpdates"
STREAM_PROGRESS = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent"

# Where a task event holds what, and its type.
_TASK_FIELDS = {
    "stage_id": ("Stage ID", "bigint"),
    "stage_attempt": ("Stage Attempt ID", "int"),
    "reason": ("Task End Reason/Reason", "string"),
    "task_id": ("Task Info/Task ID", "bigint"),
    "attempt": ("Task Info/Attempt", "int"),
    "executor_id": ("Task Info/Executor ID", "string"),
    "locality": ("Task Info/Locality", "string"),
    "launch_time": ("Task Info/Launch Time", "bigint"),
    "finish_time": ("Task Info/Finish Time", "bigint"),
    "getting_result_at": ("Task Info/Getting Result Time", "bigint"),
    "failed": ("Task Info/Failed", "boolean"),
    "killed": ("Task Info/Killed", "boolean"),
    "deserialize_time": ("Task Metrics/Executor Deserialize Time", "bigint"),
    "run_time": ("Task Metrics/Executor Run Time", "bigint"),
    "gc_time": ("Task Metrics/JVM GC Time", "bigint"),
    "serialize_time": ("Task Metrics/Result Serialization Time", "bigint"),
    "peak_memory": ("Task Metrics/Peak Execution Memory", "bigint"),
    "memory_spilled": ("Task Metrics/Memory Bytes Spilled", "bigint"),
    "disk_spilled": ("Task Metrics/Disk Bytes Spilled", "bigint"),
    "fetch_wait": ("Task Metrics/Shuffle Read Metrics/Fetch Wait Time", "bigint"),
    "remote_read": ("Task Metrics/Shuffle Read Metrics/Remote Bytes Read", "bigint"),
    "local_read": ("Task Metrics/Shuffle Read Metrics/Local Bytes Read", "bigint"),
    "shuffle_written": ("Task Metrics/Shuffle Write Metrics/Shuffle Bytes Written", "bigint"),
    "write_nanos": ("Task Metrics/Shuffle Write Metrics/Shuffle Write Time", "bigint"),
    "input_bytes": ("Task Metrics/Input Metrics/Bytes Read", "bigint"),
    "input_records": ("Task Metrics/Input Metrics/Records Read", "bigint"),
}
# Columns computed from others.
_TASK_DERIVED = {
    "shuffle_read": (["remote_read", "local_read"], "remote_read + local_read"),
    "shuffle_write_time": (["write_nanos"], "write_nanos div 1000000"),
    "duration": (["launch_time", "finish_time"], "finish_time - launch_time"),
    "getting_result": (
        ["getting_result_at", "finish_time"],
        "if(getting_result_at > 0, finish_time - getting_result_at, 0L)",
    ),
    "scheduler_delay": (
        ["duration", "run_time", "deserialize_time", "serialize_time", "getting_result"],
        "greatest(duration - run_time - deserialize_time - serialize_time - getting_result, 0L)",
    ),
}
_HELPERS = {"getting_result_at", "remote_read", "local_read", "write_nanos"}
TASK_COLUMNS = [c for c in [*_TASK_FIELDS, *_TASK_DERIVED] if c not in _HELPERS]
_NEVER_NULL = {"bigint": "0L", "boolean": "false"}


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Event logs below a folder: ``app`` from the file name, ``event`` and the raw ``value``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    app = F.regexp_extract(name, r"(?:events_\d+_)?([^.]+)", 1)
    return with_event(lines.select(app.alias("app"), "value"))


def with_event(lines: DataFrame) -> DataFrame:
    """Add the event name to a table with ``app`` and ``value``.

    Spark writes the name first, so that the rest of the line need not be parsed.
    """
    head = F.lit('{"Event":"')
    name = F.substring_index(F.substring("value", 11, 200), '"', 1)
    quick = F.when(F.col("value").startswith(head), name)
    return lines.withColumn("event", quick.otherwise(F.get_json_object("value", "$.Event")))


def _of(log: DataFrame, event: str, schema: str) -> DataFrame:
    return log.filter(F.col("event") == event).select("app", F.from_json("value", schema).alias("e"))


def _nested(paths: dict[str, str]) -> str:
    """A struct type as text from slash-separated paths and their types."""
    groups: dict[str, dict[str, str]] = {}
    parts = []
    for path, kind in paths.items():
        head, _, rest = path.partition("/")
        if rest:
            groups.setdefault(head, {})[rest] = kind
        else:
            parts.append(f"`{head}`: {kind}")
    parts += [f"`{head}`: {_nested(inner)}" for head, inner in groups.items()]
    return f"struct<{', '.join(parts)}>"


def tasks(log: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per finished task attempt. Times in milliseconds, sizes in bytes.

    Only the fields behind ``columns`` are parsed out of an event.
    """
    wanted = list(columns) if columns is not None else TASK_COLUMNS
    pending, needed = list(wanted), set()
    while pending:
        column = pending.pop()
        needed.add(column)
        pending += [c for c in _TASK_DERIVED.get(column, ([], ""))[0] if c not in needed]
    fields = {c: spec for c, spec in _TASK_FIELDS.items() if c in needed}
    parsed = _of(log, TASK_END, _nested({path: kind for path, kind in fields.values()}))

    def read(column: str, path: str, kind: str):
        value = F.col("e." + ".".join(f"`{p}`" for p in path.split("/")))
        default = _NEVER_NULL.get(kind)
        return (F.coalesce(value, F.expr(default)) if default else value).alias(column)

    flat = parsed.select("app", *[read(c, path, kind) for c, (path, kind) in fields.items()])
    for column, (_, text) in _TASK_DERIVED.items():
        if column in needed:
            flat = flat.withColumn(column, F.expr(text))
    return flat.select("app", *wanted)


def jobs(log: DataFrame) -> DataFrame:
    """One row per job: submission, completion, result, number of stages, SQL execution."""
    started = _of(
        log, JOB_START, "`Job ID` bigint, `Submission Time` bigint, `Stage IDs` array<bigint>, Properties map<string,string>"
    ).select(
        "app",
        F.col("e.`Job ID`").alias("job_id"),
        F.col("e.`Submission Time`").alias("submitted"),
        F.col("e.`Stage IDs`").alias("stage_ids"),
        F.try_element_at("e.Properties", F.lit("spark.sql.execution.id")).cast("bigint").alias("execution_id"),
    )
    ended = _of(log, JOB_END, "`Job ID` bigint, `Completion Time` bigint, `Job Result` struct<Result: string>").select(
        "app",
        F.col("e.`Job ID`").alias("job_id"),
        F.col("e.`Completion Time`").alias("completed"),
        F.col("e.`Job Result`.Result").alias("result"),
    )
    return started.join(ended, ["app", "job_id"], "left")


def stages(log: DataFrame) -> DataFrame:
    """One row per completed stage attempt."""
    schema = """`Stage Info` struct<`Stage ID`: bigint, `Stage Attempt ID`: int, `Stage Name`: string,
        `Number of Tasks`: int, `Submission Time`: bigint, `Completion Time`: bigint, `Failure Reason`: string>"""
    info = "e.`Stage Info`"
    return _of(log, STAGE_COMPLETED, schema).select(
        "app",
        F.col(f"{info}.`Stage ID`").alias("stage_id"),
        F.col(f"{info}.`Stage Attempt ID`").alias("stage_attempt"),
        F.col(f"{info}.`Stage Name`").alias("stage_name"),
        F.col(f"{info}.`Number of Tasks`").alias("num_tasks"),
        F.col(f"{info}.`Submission Time`").alias("submitted"),
        F.col(f"{info}.`Completion Time`").alias("completed"),
        F.col(f"{info}.`Failure Reason`").alias("failure"),
    )


def executors(log: DataFrame) -> DataFrame:
    """One row per executor: cores, and when and why it was lost."""
    added = _of(
        log, EXECUTOR_ADDED, "Timestamp bigint, `Executor ID` string, `Executor Info` struct<`Total Cores`: int>"
    ).select(
        "app",
        F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.Timestamp").alias("added"),
        F.col("e.`Executor Info`.`Total Cores`").alias("cores"),
    )
    removed = _of(log, EXECUTOR_REMOVED, "Timestamp bigint, `Executor ID` string, `Removed Reason` string").select(
        "app",
        F.col("e.`Executor ID`").alias("executor_id"),
        F.col("e.Timestamp").alias("removed"),
        F.col("e.`Removed Reason`").alias("removed_reason"),
    )
    return added.join(removed, ["app", "executor_id"], "left")


def properties(log: DataFrame) -> DataFrame:
    """Session properties: one row per application and name."""
    return _of(log, ENVIRONMENT, "`Spark Properties` map<string,string>").select(
        "app", F.explode("e.`Spark Properties`").alias("name", "value")
    )


def stream_progress(log: DataFrame) -> DataFrame:
    """One row per finished micro-batch of a streaming query."""
    schema = """progress struct<id: string, runId: string, name: string, timestamp: string, batchId: bigint,
        numInputRows: bigint, durationMs: map<string,bigint>,
        sources: array<struct<description: string, numInputRows: bigint>>>"""
    rows = F.aggregate(
        F.coalesce("e.progress.sources", F.array()), F.lit(0).cast("bigint"),
        lambda total, s: total + F.coalesce(s["numInputRows"], F.lit(0)),
    )
    return _of(log, STREAM_PROGRESS, schema).select(
        "app",
        F.col("e.progress.id").alias("query_id"),
        F.col("e.progress.batchId").alias("batch_id"),
        F.col("e.progress.timestamp").alias("started"),
        F.coalesce(F.col("e.progress.numInputRows"), rows).alias("input_rows"),
        F.try_element_at("e.progress.durationMs", F.lit("triggerExecution")).alias("duration"),
    )


_NODES = "app string, execution_id bigint, node string, metric string, metric_type string, accumulator_id bigint"


def _walk_plans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Flatten plan trees of any depth; there is one plan or so per SQL execution."""
    for batch in batches:
        found = []
        for app, execution_id, text in zip(batch["app"], batch["execution_id"], batch["plan"]):
            open_nodes = [json.loads(text)] if text else []
            while open_nodes:
                node = open_nodes.pop()
                open_nodes.extend(node.get("children", []))
                for m in node.get("metrics", []):
                    found.append(
                        (app, execution_id, node["nodeName"].strip(), m["name"], m["metricType"], m["accumulatorId"])
                    )
        yield pd.DataFrame(
            found, columns=["app", "execution_id", "node", "metric", "metric_type", "accumulator_id"]
        )


def plan_metrics(log: DataFrame) -> DataFrame:
    """Which operator of which SQL execution owns a metric, adaptive plans included."""
    plans = log.filter(F.col("event").isin(SQL_START, SQL_ADAPTIVE)).select(
        "app",
        F.get_json_object("value", "$.executionId").cast("bigint").alias("execution_id"),
        F.get_json_object("value", "$.sparkPlanInfo").alias("plan"),
    )
    return plans.mapInPandas(_walk_plans, _NODES).dropDuplicates(["app", "execution_id", "accumulator_id"])


def metric_updates(log: DataFrame) -> DataFrame:
    """What tasks and the driver added to each metric: one row per metric."""
    by_task = _of(
        log, TASK_END, "`Task Info` struct<Accumulables: array<struct<ID: bigint, Update: string, Metadata: string>>>"
    ).select("app", F.explode("e.`Task Info`.Accumulables").alias("a"))
    by_task = by_task.filter(F.col("a.Metadata") == "sql").select(
        "app", F.col("a.ID").alias("accumulator_id"), F.expr("try_cast(a.Update AS bigint)").alias("value")
    )
    by_driver = _of(log, SQL_DRIVER_METRICS, "executionId bigint, accumUpdates array<array<bigint>>").select(
        "app", F.explode("e.accumUpdates").alias("a")
    )
    by_driver = by_driver.select("app", F.col("a")[0].alias("accumulator_id"), F.col("a")[1].alias("value"))
    updates = by_task.unionByName(by_driver).filter(F.col("value") >= 0)
    return updates.groupBy("app", "accumulator_id").agg(
        F.sum("value").alias("total"), F.max("value").alias("largest")
    )
