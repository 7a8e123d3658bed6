"""What to look at in a finished run: reports over event-log tables, with thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.diagnosis import eventlog
from tablewright.functions.columns import safe_divide
from tablewright.operators.ordered import OrderedGroups

# Thresholds of the reports.
SKEW_WARN = 3.0
SKEW_BAD = 5.0
FETCH_WAIT_SHARE = 0.10
GC_SHARE = 0.10
OVERHEAD_SHARE = 0.05
POST_SHUFFLE_BYTES = (128 * 1024 * 1024, 256 * 1024 * 1024)
# Spark's defaults for the settings that are checked.
SETTING_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.autoBroadcastJoinThreshold": "10485760b",
}

STAGE = ("app", "stage_id", "stage_attempt")


def _share(part: str, whole: str) -> Column:
    return F.coalesce(safe_divide(F.sum(part), F.sum(whole)), F.lit(0.0))


def stage_skew(tasks: DataFrame, warn: float = SKEW_WARN, bad: float = SKEW_BAD) -> DataFrame:
    """Distribution of task times per stage; how far the slowest is off the median."""
    points = F.percentile_approx("duration", [0.5, 0.95, 0.99], 10_000)
    stats = tasks.groupBy(*STAGE).agg(
        F.count(F.lit(1)).alias("num_tasks"), points.alias("p"), F.max("duration").alias("max_time")
    )
    ratio = F.coalesce(safe_divide(F.col("max_time"), F.col("p50")), F.lit(1.0))
    return (
        stats.withColumns({"p50": F.col("p")[0], "p95": F.col("p")[1], "p99": F.col("p")[2]})
        .drop("p")
        .withColumn("max_to_median", ratio)
        .withColumn(
            "verdict",
            F.when(F.col("max_to_median") > bad, F.lit("SKEWED"))
            .when(F.col("max_to_median") > warn, F.lit("WARN"))
            .otherwise(F.lit("OK")),
        )
    )


def shuffle_report(tasks: DataFrame, max_wait: float = FETCH_WAIT_SHARE) -> DataFrame:
    return (
        tasks.groupBy(*STAGE)
        .agg(
            F.sum("shuffle_read").alias("read_bytes"),
            F.max("shuffle_read").alias("max_read_bytes"),
            F.sum("shuffle_written").alias("written_bytes"),
            F.sum("shuffle_write_time").alias("write_time"),
            F.sum("fetch_wait").alias("fetch_wait"),
            _share("fetch_wait", "duration").alias("wait_share"),
        )
        .withColumn("slow_fetch", F.col("wait_share") >= max_wait)
    )


def gc_report(tasks: DataFrame, by: Sequence[str] = STAGE, max_share: float = GC_SHARE) -> DataFrame:
    """Garbage collection against run time, by stage or by executor."""
    return (
        tasks.groupBy(*by)
        .agg(
            F.sum("gc_time").alias("gc_time"),
            F.sum("run_time").alias("run_time"),
            _share("gc_time", "run_time").alias("gc_share"),
        )
        .withColumn("memory_pressure", F.col("gc_share") >= max_share)
    )


def overhead_report(tasks: DataFrame, max_share: float = OVERHEAD_SHARE) -> DataFrame:
    """Time that does no useful work, each kind as a share of task time."""
    kinds = {
        "scheduler_share": "scheduler_delay",
        "deserialize_share": "deserialize_time",
        "serialize_share": "serialize_time",
        "result_share": "getting_result",
    }
    shares = tasks.groupBy(*STAGE).agg(*[_share(c, "duration").alias(n) for n, c in kinds.items()])
    return shares.withColumn("too_high", F.greatest(*kinds) >= max_share)


def failure_report(tasks: DataFrame, executors: DataFrame | None = None) -> DataFrame:
    """Failed, killed and repeated tasks per stage, with the executors the application lost."""
    counts = tasks.groupBy(*STAGE).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("failed")).alias("failed"),
        F.count_if(F.col("killed")).alias("killed"),
        F.count_if(F.col("attempt") > 0).alias("retried"),
    )
    if executors is None:
        return counts
    lost = executors.groupBy("app").agg(F.count("removed").alias("lost_executors"))
    return counts.join(lost, "app", "left").na.fill(0, ["lost_executors"])


def utilization(tasks: DataFrame, executors: DataFrame, bucket_ms: int = 60_000) -> DataFrame:
    """Busy cores per executor and time bucket, against the cores it has.

    A task counts in each bucket with the milliseconds it ran there.
    """
    width = F.lit(bucket_ms)
    # No filter here: it would be pushed down and have every event parsed twice.
    numbers = F.expr(
        f"CASE WHEN finish_time > launch_time "
        f"THEN sequence(launch_time div {bucket_ms}, (finish_time - 1) div {bucket_ms}) END"
    )
    spans = tasks.select("app", "executor_id", "launch_time", "finish_time", F.explode(numbers).alias("bucket"))
    inside = F.least("finish_time", (F.col("bucket") + 1) * width) - F.greatest("launch_time", F.col("bucket") * width)
    busy = spans.groupBy("app", "executor_id", "bucket").agg(F.sum(inside).alias("busy_ms"))
    cores = executors.groupBy("app", "executor_id").agg(F.max("cores").alias("cores"))
    return busy.join(cores, ["app", "executor_id"], "left").select(
        "app",
        "executor_id",
        (F.col("bucket") * width).alias("bucket_start"),
        "busy_ms",
        (F.col("busy_ms") / width).alias("active_tasks"),
        "cores",
        safe_divide(F.col("busy_ms") / width, F.col("cores")).alias("busy_share"),
    )


def spill_report(tasks: DataFrame) -> DataFrame:
    return (
        tasks.groupBy(*STAGE)
        .agg(
            F.sum("memory_spilled").alias("memory_spilled"),
            F.sum("disk_spilled").alias("disk_spilled"),
            F.max("peak_memory").alias("peak_memory"),
        )
        .withColumn("spills", (F.col("memory_spilled") > 0) | (F.col("disk_spilled") > 0))
    )


def locality_report(tasks: DataFrame) -> DataFrame:
    """Tasks per locality level and their share of the application."""
    counts = tasks.groupBy("app", "locality").agg(F.count(F.lit(1)).alias("num_tasks"))
    whole = F.sum("num_tasks").over(Window.partitionBy("app"))  # a handful of levels per application
    return counts.withColumn("share", F.col("num_tasks") / whole)


def executor_balance(tasks: DataFrame) -> DataFrame:
    """Input and shuffle bytes per executor against the average of the application."""
    per_executor = tasks.groupBy("app", "executor_id").agg(
        F.count(F.lit(1)).alias("num_tasks"),
        F.sum("input_bytes").alias("input_bytes"),
        F.sum("shuffle_read").alias("shuffle_read"),
        F.sum("shuffle_written").alias("shuffle_written"),
    )
    volume = F.col("input_bytes") + F.col("shuffle_read")
    mean = F.avg(volume).over(Window.partitionBy("app"))  # one row per executor
    return per_executor.withColumn("to_average", F.coalesce(safe_divide(volume, mean), F.lit(1.0)))


def job_report(jobs: DataFrame, **sizing) -> DataFrame:
    """Duration and stages of each job, and the idle time since the job before it began or ended."""
    groups = OrderedGroups(jobs, ["app"], ["submitted", "job_id"], **sizing)
    rows = groups.with_neighbour(groups.df, F.struct(F.col("completed").alias("completed")), "__before")
    gap = F.greatest(F.col("submitted") - F.col("__before.completed"), F.lit(0))
    return groups.finish(rows).select(
        "app",
        "job_id",
        (F.col("completed") - F.col("submitted")).alias("duration"),
        F.size("stage_ids").alias("num_stages"),
        F.when(F.col("__before").isNotNull(), gap).alias("idle_before"),
        (F.col("result") == "JobSucceeded").alias("succeeded"),
    )


def sql_operators(log: DataFrame) -> DataFrame:
    """Per SQL execution, operator and metric: total and largest contribution.

    Rows, bytes and times of scans, exchanges, broadcasts, aggregations and sorts.
    """
    named = eventlog.plan_metrics(log)
    updates = eventlog.metric_updates(log)
    return (
        named.join(updates, ["app", "accumulator_id"])
        .groupBy("app", "execution_id", "node", "metric", "metric_type")
        .agg(F.sum("total").alias("total"), F.max("largest").alias("largest"))
    )


def config_check(properties: DataFrame) -> DataFrame:
    """The settings that matter most, as set or by default, with a verdict."""
    found = [F.max(F.when(F.col("name") == n, F.col("value"))) for n in SETTING_DEFAULTS]
    settings = [
        F.struct(F.lit(n).alias("setting"), F.lit(default).alias("default"), value.alias("value"))
        for (n, default), value in zip(SETTING_DEFAULTS.items(), found)
    ]
    per_app = properties.groupBy("app").agg(F.array(*settings).alias("s")).select("app", F.inline("s"))
    value = F.coalesce(F.col("value"), F.col("default"))
    switch = F.col("setting").endswith(".enabled")
    return per_app.select(
        "app",
        "setting",
        value.alias("value"),
        F.col("value").isNotNull().alias("is_set"),
        F.when(switch & (value != "true"), F.lit("TURN_ON")).otherwise(F.lit("OK")).alias("verdict"),
    )


def stream_health(progress: DataFrame) -> DataFrame:
    """Batches, rows and durations per streaming query."""
    return progress.groupBy("app", "query_id").agg(
        F.count_distinct("batch_id").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.max("duration").alias("max_duration"),
        F.sum("duration").alias("total_duration"),
    )


# Advice by cause.
ADVICE = {
    "skew": "split hot keys by salting, let adaptive execution handle skew, or repartition",
    "spill": "use more and smaller partitions, or narrower rows",
    "fetch_wait": "broadcast the small side, fix skew, or add partitions",
    "gc": "narrow the rows, cache less, or give executors more memory",
    "overhead": "use fewer and larger tasks, and compact small files",
    "failures": "read the logs for lost executors and memory errors",
}


def triage(tasks: DataFrame) -> DataFrame:
    """Findings of all stages, ranked per application by the task time they concern.

    All measures come from one aggregation per stage. ``severity`` is how far the measure
    exceeds its threshold.
    """
    per_stage = tasks.groupBy(*STAGE).agg(
        F.sum("duration").alias("task_time"),
        F.max("duration").alias("longest"),
        F.percentile_approx("duration", 0.5, 10_000).alias("median"),
        (F.sum("memory_spilled") + F.sum("disk_spilled")).alias("spilled"),
        F.count_if(F.col("failed")).alias("failed"),
        _share("fetch_wait", "duration").alias("wait_share"),
        _share("gc_time", "run_time").alias("gc_share"),
        F.coalesce(
            safe_divide(
                F.sum(F.col("scheduler_delay") + F.col("deserialize_time") + F.col("serialize_time")),
                F.sum("duration"),
            ),
            F.lit(0.0),
        ).alias("overhead_share"),
    )
    skew = F.coalesce(safe_divide(F.col("longest"), F.col("median")), F.lit(1.0)) / SKEW_WARN
    measures = {
        "skew": skew,
        "spill": F.when(F.col("spilled") > 0, F.lit(2.0)).otherwise(F.lit(0.0)),
        "fetch_wait": F.col("wait_share") / FETCH_WAIT_SHARE,
        "gc": F.col("gc_share") / GC_SHARE,
        "overhead": F.col("overhead_share") / OVERHEAD_SHARE,
        "failures": F.when(F.col("failed") > 0, F.lit(2.0)).otherwise(F.lit(0.0)),
    }
    causes = F.array(
        *[F.struct(F.lit(n).alias("cause"), m.cast("double").alias("severity")) for n, m in measures.items()]
    )
    advice = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    found = (
        per_stage.select(*STAGE, "task_time", F.explode(causes).alias("c"))
        .filter(F.col("c.severity") > 1)
        .select(*STAGE, "task_time", "c.cause", "c.severity", advice[F.col("c.cause")].alias("advice"))
    )
    # A row per stage and cause: far fewer than there are tasks.
    order = Window.partitionBy("app").orderBy(F.desc("task_time"), F.desc("severity"), "stage_id", "stage_attempt", "cause")
    return found.withColumn("position", F.row_number().over(order))
