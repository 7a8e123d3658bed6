"""Properties of plans that decide how a query does on large tables."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan_of(spark):
    return lambda name: plan(entry.queries()[name](spark, FOLDER))


def test_no_python_in_the_plans(plan_of):
    for name in ("clean_pipeline", "cdc_scd2_track", "merge_conditional", "apply_change_feed", "quality_rules", "mask_email", "log_triage"):
        assert not re.search(r"EvalPython|MapInPandas|FlatMapGroupsInPandas", plan_of(name)), name


def test_no_window_without_partitions(spark, plan_of):
    for name in ("rank_in_group", "running_total", "dedup_latest", "top_values", "cdc_scd2", "manual_history_row", "log_triage"):
        for window in re.findall(r"\bWindow \[[^\n]*windowspecdefinition\(([^)]*)", plan_of(name)):
            assert re.match(r"\w+#", window), (name, window)


def test_rows_are_dropped_before_the_shuffle(plan_of):
    for name in ("topn_per_group", "dedup_latest", "drop_duplicates_key", "net_changes", "cdc_scd1", "top_values"):
        assert re.search(r"WindowGroupLimit .*Partial", plan_of(name)), name


def test_history_takes_one_shuffle(plan_of):
    for name in ("cdc_scd2", "cdc_scd2_track", "restore_version", "snapshot_diff"):
        assert plan_of(name).count("Exchange hashpartitioning") == 1, name


def test_one_scan_profiles_all_columns(plan_of):
    for name in ("profile_table", "null_counts", "quality_report"):
        assert plan_of(name).count("FileScan") == 1, name


def test_filters_and_columns_reach_the_scan(plan_of):
    text = plan_of("in_like_between")
    assert re.search(r"PushedFilters: \[[^\]]*In\(o_orderstatus", text)
    assert "o_custkey" not in text
    text = plan_of("partition_pruned_scan")
    assert re.search(r"PartitionFilters: \[[^\]]*dt#", text)
    scanned = re.search(r"ReadSchema: struct<([^>]*)>", plan_of("two_phase_agg")).group(1)
    assert {c.split(":")[0] for c in scanned.split(",")} == {"l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_no_cross_joins(plan_of):
    for name in ("cdc_scd1_truncate", "high_water_mark", "apply_change_feed", "quantiles", "ndv_counts", "scd2_as_of"):
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan_of(name)), name


def test_sort_with_limit_keeps_only_the_best(plan_of):
    assert "TakeOrderedAndProject" in plan_of("sort_limit")
