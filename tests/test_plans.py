"""Plan shape: what reaches the scan, and no raw rows in a one-task window."""

import re

import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_scan_is_pruned_and_filtered(spark, sf):
    text = plan(QUERIES["quantile_cap"](spark, sf))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text
    text = plan(QUERIES["feature_means_by_correctness"](spark, sf))
    assert "PushedFilters: [IsNotNull(o_orderkey)" in text


@pytest.mark.parametrize("key", ["feature_transform_fitted", "apply_decision", "soft_vote"])
def test_row_wise_operators_add_no_shuffle_of_their_own(key, spark, sf):
    """Only the joins that build the demo views may move rows."""
    text = plan(QUERIES[key](spark, sf))
    assert "Window" not in text and "SinglePartition" not in text


@pytest.mark.parametrize("key", [
    "auc_ovr", "ks_per_class", "roc_points", "label_shift_w1", "describe_numeric", "psi_table",
    "box_stats_by_class", "score_stability", "stratified_split3", "heartbeat_gap", "alert_pending_firing",
    "value_counts_topk", "iqr_outliers", "error_rate_5m"])
def test_windows_are_partitioned(key, spark, sf):
    text = plan(QUERIES[key](spark, sf))
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line):
            assert re.search(r"\], \[[^\]]*#", line), line


def test_top_values_are_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(QUERIES["value_counts_topk"](spark, sf))


def test_small_sides_are_broadcast(spark, sf):
    text = plan(QUERIES["stratified_split3"](spark, sf))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
