from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewright.operators.changes import (
    advance_mark, apply_change_feed, as_of, net_changes, next_version, read_changes, restore, snapshot_diff,
)

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, v string, _change_type string, _commit_version bigint, _commit_timestamp timestamp_ntz"


@pytest.fixture
def log(spark):
    steps = [
        (1, "a", "insert", 1), (2, "b", "insert", 1),
        (1, "a", "update_preimage", 2), (1, "A", "update_postimage", 2),
        (2, "b", "delete", 3), (3, None, "insert", 3),
        (2, "B", "insert", 4), (3, None, "delete", 4),
        (1, "A", "delete", 5), (1, "AA", "insert", 5),
    ]
    return spark.createDataFrame([(i, v, c, n, T0 + timedelta(days=n)) for i, v, c, n in steps], SCHEMA)


STATES = {1: {(1, "a"), (2, "b")}, 2: {(1, "A"), (2, "b")}, 3: {(1, "A"), (3, None)}, 4: {(1, "A"), (2, "B")}, 5: {(1, "AA"), (2, "B")}}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_every_version(log):
    for version, state in STATES.items():
        assert rows(as_of(log, ["id"], version)) == state
        assert rows(as_of(log, ["id"], T0 + timedelta(days=version))) == state
    assert rows(as_of(log, ["id"])) == STATES[5]


def test_bounds_are_included(log):
    assert read_changes(log, 2, 3).count() == 4
    assert read_changes(log, 2, 3, ["insert"]).count() == 1
    assert read_changes(log, T0 + timedelta(days=4)).count() == 4


def test_restore_appended_to_the_log(log):
    for version, state in STATES.items():
        back = restore(log, ["id"], version, 6, T0 + timedelta(days=6))
        back = back.withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))
        assert rows(as_of(log.unionByName(back), ["id"])) == state


@pytest.mark.parametrize("version", [1, 2, 3, 4, 5])
def test_apply_from_any_mark(spark, log, version):
    mark = spark.createDataFrame([("t", version), ("other", 99)], "table_name string, processed_version bigint")
    state, marks = apply_change_feed(as_of(log, ["id"], version), log, mark, "t", ["id"])
    assert rows(state) == STATES[5]
    assert rows(marks) == {("t", 5), ("other", 99)}


def test_mark_without_news_and_without_past(spark, log):
    mark = spark.createDataFrame([("t", 5)], "table_name string, processed_version bigint")
    pending = read_changes(log, start=6).agg(F.max("_commit_version"))
    assert rows(advance_mark(mark, "t", pending)) == {("t", 5)}
    assert next_version(mark, "unseen").first()[0] == 1
    assert rows(advance_mark(mark.limit(0), "t", log.agg(F.max("_commit_version")))) == {("t", 5)}


def test_diff_applied_gives_the_new_snapshot(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (None, None)], "id int, v string")
    diff = snapshot_diff(old, new, ["id"], 2, T0)
    kinds = {(r.id, r.v, r._change_type) for r in diff.collect()}
    assert kinds == {
        (2, None, "update_preimage"), (2, "b", "update_postimage"), (3, "c", "delete"), (4, None, "insert"),
        (None, "n", "update_preimage"), (None, None, "update_postimage"),
    }
    first = snapshot_diff(old.limit(0), old, ["id"], 1, T0)
    assert rows(as_of(first.unionByName(diff), ["id"])) == rows(new)


def test_diff_needs_keys_that_identify_rows(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    with pytest.raises(Exception, match="do not identify rows"):
        snapshot_diff(old, old.limit(0), ["id"], 1, T0).collect()


def test_net_changes_one_row_per_key(log):
    assert {(r.id, r._change_type, r._commit_version) for r in net_changes(log, ["id"]).collect()} == {
        (1, "insert", 5), (2, "insert", 4), (3, "delete", 4),
    }


def test_what_the_log_gains_meanwhile_is_left_to_the_next_run(spark, log, folder):
    log.write.parquet(folder)
    growing = spark.read.parquet(folder)
    mark = spark.createDataFrame([("t", 3)], "table_name string, processed_version bigint")
    state, marks = apply_change_feed(as_of(log, ["id"], 3), growing, mark, "t", ["id"])
    late = spark.createDataFrame([(7, "late", "insert", 6, T0 + timedelta(days=6)), (1, None, "delete", 6, T0 + timedelta(days=6))], SCHEMA)
    late.write.mode("append").parquet(folder)
    spark.catalog.refreshByPath(folder)
    assert rows(state) == STATES[5] and rows(marks) == {("t", 5)}
    again, after = apply_change_feed(as_of(log, ["id"], 5), spark.read.parquet(folder), marks, "t", ["id"])
    assert rows(again) == {(2, "B"), (7, "late")} and rows(after) == {("t", 6)}


def test_an_empty_log_changes_nothing(spark, log):
    mark = spark.createDataFrame([("t", 3)], "table_name string, processed_version bigint")
    state, marks = apply_change_feed(as_of(log, ["id"], 3), log.limit(0), mark, "t", ["id"])
    assert rows(state) == STATES[3] and rows(marks) == {("t", 3)}


def test_diff_of_maps(spark):
    kind = "id int, m map<string,int>, v int"
    old = spark.createDataFrame([(1, {"a": 1, "b": 2}, 1), (2, {"a": 1}, 1), (3, None, 1), (4, {"x": 1}, 1)], kind)
    new = spark.createDataFrame([(1, {"b": 2, "a": 1}, 1), (2, {"a": 2}, 1), (3, {}, 1), (5, {"y": None}, 1)], kind)
    found = snapshot_diff(old, new, ["id"], 7, T0)
    assert found.schema["m"].dataType == old.schema["m"].dataType
    assert sorted((r.id, r._change_type) for r in found.collect()) == [
        (2, "update_postimage"), (2, "update_preimage"), (3, "update_postimage"), (3, "update_preimage"), (4, "delete"), (5, "insert"),
    ]
    with pytest.raises(Exception, match="do not identify rows"):
        snapshot_diff(old.unionAll(old), new, ["id"], 7, T0).collect()
