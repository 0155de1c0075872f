"""Plans that must keep their shape, since scale depends on it."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dedup_first_wins", "top_n_per_community", "notify_caps"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    plan = _plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_topk_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "topk_scored")
    assert "TakeOrderedAndProject" in _plan(spark, "log_tail_health")


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "export_filtered")
    assert re.search(r"PushedFilters: \[[^\]]*In\(source", plan)
    plan = _plan(spark, "histogram_quantile")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_store_check_is_an_anti_join(spark):
    assert "LeftAnti" in _plan(spark, "dedup_vs_store")


def test_scoring_with_a_small_lexicon_does_not_shuffle(spark):
    assert "Exchange" not in _plan(spark, "score_lexicon")


@pytest.mark.parametrize("name", ["counter_increase", "rate_ratio", "recording_rules",
                                  "failure_streak", "incident_actions", "alert_inhibit",
                                  "alert_intervals", "histogram_quantile_rate"])
def test_windows_over_series_are_chunked(spark, name):
    """Windows by series alone may read one row per chunk, never the rows themselves."""
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert re.search(r"Exchange hashpartitioning\([^)]*__chunk", plan)


@pytest.mark.parametrize("name", ["dup_flag", "dedup_vs_store", "batch_scored_posts"])
def test_hash_is_not_computed_to_find_nulls(spark, name):
    assert "isnotnull(sha2" not in _plan(spark, name)


@pytest.mark.parametrize("name", ["dup_flag", "store_stats", "histogram_buckets", "gauge_latest",
                                  "incident_state", "manifest_totals", "counter_increase"])
def test_aggregations_hash(spark, name):
    assert "SortAggregate" not in _plan(spark, name)


def test_python_only_where_said(spark):
    # Streams and fitting run while the query is built.
    slow = {"score_udf", "score_failures", "file_manifest"}
    for name in entry.queries():
        if name.startswith("stream_") or name in ("score_trained", "csv_roundtrip",
                                                  "seen_store_restart", "dedup_strict", "run_metrics",
                                                  "run_reasons", "scrape_ingestion", "status_json"):
            continue
        plan = _plan(spark, name)
        assert "BatchEvalPython" not in plan
        if name not in slow:
            assert "Pandas" not in plan and "ArrowEvalPython" not in plan, name
