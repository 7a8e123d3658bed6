import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tablewright.diagnosis import eventlog, reports

JOB = """
import sys
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").appName("observed").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
    .config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.skewJoin.enabled", "false").getOrCreate())
spark.range(20000).groupBy((F.col("id") % 7).alias("k")).count().orderBy("k").collect()
stream = spark.readStream.schema("value string").text(sys.argv[2])
stream.writeStream.format("noop").option("checkpointLocation", sys.argv[3]).trigger(availableNow=True).start().awaitTermination()
spark.stop()
"""


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The event log of a real application, run in a process of its own."""
    base = tmp_path_factory.mktemp("run")
    for name in ("events", "in", "ckpt"):
        (base / name).mkdir()
    (base / "in" / "a.txt").write_text("x\ny\nz\n")
    script = base / "job.py"
    script.write_text(JOB)
    args = [str(base / n) for n in ("events", "in", "ckpt")]
    subprocess.run([sys.executable, str(script), *args], check=True, timeout=240, capture_output=True)
    return eventlog.read_event_log(spark, args[0]).cache()


def test_real_tasks(log):
    tasks = eventlog.tasks(log)
    assert log.select("app").distinct().count() == 1
    assert tasks.count() > 3
    wrong = "duration < 0 OR run_time > duration OR reason <> 'Success' OR executor_id <> 'driver' OR locality IS NULL"
    assert tasks.filter(wrong).count() == 0
    assert tasks.agg(F.sum("shuffle_written")).first()[0] > 0
    assert eventlog.tasks(log, ["duration"]).columns == ["app", "duration"]


def test_real_jobs_stages_and_executors(log):
    jobs = reports.job_report(eventlog.jobs(log)).collect()
    assert jobs and all(j.succeeded and j.duration >= 0 and j.num_stages > 0 for j in jobs)
    stages = eventlog.stages(log)
    assert stages.count() > 0 and stages.filter("completed < submitted OR num_tasks < 1").count() == 0
    used = reports.utilization(eventlog.tasks(log), eventlog.executors(log), 1000).collect()
    assert used and all(0 < u.busy_share and u.cores == 2 for u in used)


def test_real_settings(log):
    found = {r.setting: r for r in reports.config_check(eventlog.properties(log)).collect()}
    assert found["spark.sql.adaptive.skewJoin.enabled"].verdict == "TURN_ON"
    assert found["spark.sql.shuffle.partitions"].value == "4"
    assert not found["spark.sql.autoBroadcastJoinThreshold"].is_set


def test_real_operators(log):
    found = reports.sql_operators(log).filter("total > 0")
    rows = {(r.node, r.metric): r.total for r in found.filter("metric = 'number of output rows'").collect()}
    assert any(node.startswith("Range") and total == 20000 for (node, _), total in rows.items())
    assert found.filter("node LIKE 'Exchange%' AND metric = 'shuffle bytes written'").count() > 0


def test_real_stream(log):
    health = reports.stream_health(eventlog.stream_progress(log)).collect()
    assert sum(h.input_rows for h in health) == 3


def test_the_skewed_stage_is_named_first(spark):
    tasks = spark.range(400).select(
        F.lit("app").alias("app"), (F.col("id") % 4).alias("stage_id"), F.lit(0).alias("stage_attempt"), "id"
    )
    slow = (F.col("stage_id") == 2) & (F.col("id") > 390)
    duration = F.when(slow, F.lit(90_000)).otherwise(F.lit(1000)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    tasks = tasks.withColumns(
        {
            "duration": duration,
            "run_time": duration,
            "failed": (F.col("stage_id") == 1) & (F.col("id") == 1),
            **{c: zero for c in ("memory_spilled", "disk_spilled", "fetch_wait", "gc_time", "scheduler_delay",
                                 "deserialize_time", "serialize_time")},
        }
    )
    found = reports.triage(tasks).orderBy("position").collect()
    assert [(r.stage_id, r.cause) for r in found] == [(2, "skew"), (1, "failures")]
    assert "salting" in found[0].advice
    verdicts = {r.stage_id: r.verdict for r in reports.stage_skew(tasks).collect()}
    assert verdicts == {0: "OK", 1: "OK", 2: "SKEWED", 3: "OK"}
