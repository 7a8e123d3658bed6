import pytest
from pyspark.sql import functions as F

from tablewright.operators.aggregates import two_phase_agg
from tablewright.operators.joins import broadcast_join, heavy_keys, key_budgets, measured_bytes, salted_join, touched_rows


@pytest.fixture(scope="module")
def sides(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 50 != 1, F.col("id") % 400)
    left = spark.range(6000).select(key.alias("k"), F.col("id").alias("l")).repartition(6)
    right = spark.range(350).select(F.col("id").alias("k"), (F.col("id") * 2).alias("r"))
    return left, right.unionByName(right.filter("k < 5"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [0.05, [0], []])
def test_salted_join_is_a_join(sides, how, hot):
    left, right = sides
    expected = left.join(right, "k", how)
    found = salted_join(left, right, ["k"], how, hot, salts=5).select(expected.columns)
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("task_rows", [7, 300, 10_000])
def test_salted_join_by_rows_of_a_task(sides, how, task_rows):
    left, right = sides
    expected = left.join(right, "k", how)
    found = salted_join(left, right, ["k"], how, task_rows=task_rows).select(expected.columns)
    assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


def test_salts_follow_the_rows_of_a_key(spark):
    """One key holds 90 % of the rows: no salt of it gets more than three times the rows of a task."""
    key = F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(20)).cast("string")))
    left = spark.range(40_000).select(key.alias("k"), F.lit(1).alias("j"), "id").repartition(8)
    (found,) = key_budgets(left, ["k", "j"], 1_000)
    assert found[:2] == ("hot", 1) and 30 <= found[2] <= 44
    right = left.select("k", "j").distinct().withColumn("r", F.lit(1))
    plan = salted_join(left, right, ["k", "j"], task_rows=1_000)
    assert plan.count() == 40_000
    salts = left.withColumn("s", F.pmod(F.hash("k", "j", "id") + F.spark_partition_id(), F.lit(1 << 20)) % found[2])
    sizes = [r["count"] for r in salts.filter("k = 'hot'").groupBy("s").count().collect()]
    assert len(sizes) == found[2] and max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_copies_are_spread(spark):
    left = spark.range(0, 4000, 1, 16).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    from tablewright.functions.columns import spread

    used = left.withColumn("b", spread(left.columns, 8)).groupBy("b").count().collect()
    assert len(used) == 8
    assert salted_join(left, right, ["k"], hot=[1]).count() == 4000


def test_heavy_keys(sides):
    assert [r.k for r in heavy_keys(sides[0], ["k"], 0.2)] == [0]


def test_broadcast_depends_on_the_measured_size(spark, sides):
    left, right = sides
    assert 3000 < measured_bytes(right) < 40_000
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" in plan(broadcast_join(left, right, "k"))
        assert "SortMergeJoin" in plan(broadcast_join(left, right, "k", max_bytes=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_phases_give_the_plain_result(sides):
    left, _ = sides
    measures = {"total": ("sum", "l"), "n": ("count", "l"), "low": ("min", "l"), "high": ("max", "l")}
    expected = left.groupBy("k").agg(F.sum("l"), F.count("l"), F.min("l"), F.max("l"))
    assert two_phase_agg(left, ["k"], measures).exceptAll(expected).count() == 0


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_touched_rows_small_or_large(sides, how, monkeypatch):
    left, right = sides
    expected = left.join(right, "k", how)
    for fits in (True, False):
        monkeypatch.setattr("tablewright.operators.joins.fits_broadcast", lambda df: fits)
        found = touched_rows(left, right, ["k"], how)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0
