"""Properties of the physical plans that matter at scale."""

import re

import pytest

from sensorloom import plans

SF_DIR = "/root/testdata/sf0.001"
PYTHON = {"frame_resize", "frame_resize_bytes", "frame_resize_area", "frame_mean_score_bytes", "grid_compose_in_pandas", "agg_arrow_sum_per_key",
          "udf_by_name", "window_mean_pandas", "chunk_v1_scan_matched"}
BATCH = [n for n in plans.queries() if not n.startswith("stream_")]


def plan(spark, name):
    return plans.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    # No window over all rows in one partition; only over block totals (_sum).
    for window in re.findall(r"Window \[([^\n]*)\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", text):
        assert window.startswith("sum(_sum#")
    if name not in PYTHON:
        assert not re.search("Python|InPandas|InArrow", text)


def test_reassembly_shuffles_payloads_once(spark):
    text = plan(spark, "chunk_reassemble")
    # The status side has the key, the index and numbers only; the payload is in the last grouping alone.
    assert re.search(r"HashAggregate\(keys=\[doc_id#\d+L, timestamp#\d+, chunk_index#\d+\], "
                     r"functions=\[partial_count\(1\), partial_min\(final_chunk_index#\d+\), "
                     r"partial_max\(final_chunk_index#\d+\)\]", text)
    assert len(re.findall(r" listagg\(|\[listagg\(", text)) == 1


def test_status_of_reassembly_is_computed_once(spark):
    """Planned as a whole, not by runtime steps: those leave out a branch that turns out empty, with its reuse."""
    frames = plans.queries()["chunk_reassemble"](spark, SF_DIR)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = frames._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in text
    # The status is shuffled by (key, index) and by key, once each; all else that reads it takes these.
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id#\d+L, timestamp#\d+, chunk_index#\d+", text)) == 1


@pytest.mark.parametrize("name", ["chunk_v1_scan", "chunk_v1_scan_by_key", "chunk_v1_scan_matched"])
def test_log_payloads_are_shuffled_once(spark, name):
    """One exchange of events, by block; the parts of frames that cross a block's end have one of their own."""
    whole = plans.queries()[name](spark, SF_DIR)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_of = whole._jdf.queryExecution().executedPlan()
        exchanges = re.findall(r"(?<!Reused)Exchange hashpartitioning\(([^)]*)\)[^\n]*\n", plan_of.toString())
        treestring = plan_of.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    heads = [e for e in exchanges if re.fullmatch(r"segment_id#\d+L, block#\d+L, \d+", e)]
    # Events and the lists of chunks are both dealt by block; the second branch reuses the events.
    assert len(heads) == 2, treestring
    assert treestring.count("ReusedExchange") >= 2


@pytest.mark.parametrize("name,columns", [
    ("log_scan_count", {"user_id"}), ("agg_sum_per_key", {"user_id", "value"}),
    ("session_count", {"user_id", "ts"}), ("decode_flatten", {"event_id", "props"}),
])
def test_scans_read_only_what_they_need(spark, name, columns):
    found = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert found and all({f.split(":")[0] for f in schema.split(",")} == columns for schema in found)


@pytest.mark.parametrize("name", ["grid_last_per_camera", "dedup_frames", "window_mean", "agg_sum_per_key",
                                  "sliding_count", "session_count", "chunk_errors"])
def test_aggregates_are_partial_ahead_of_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_chunk_joins_shuffle_payloads_once(spark):
    for name in ("chunk_join_inner", "chunk_join_left"):
        assert plan(spark, name).count("Exchange hashpartitioning") == 1


def test_interval_join_uses_time_buckets(spark):
    assert re.search(r"Join[^\n]*\[device_id#\d+L, _bucket#\d+L\]", plan(spark, "interval_join"))


@pytest.mark.parametrize("name, payload", [("grid_last_per_camera", "embedding|pixels"), ("grid_compose", "embedding|pixels|data"),
                                           ("dedup_frames", "value|temp_celsius")])
def test_winners_are_chosen_without_payloads(spark, name, payload):
    """No aggregate by key or its sort has the payload; the list of a window's tiles does, as it is the result."""
    text = plans.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    choosing = [line for line in text.splitlines() if re.search(r"(SortAggregate|HashAggregate)\(.*(max|min)\(", line) and "collect_list" not in line]
    assert choosing
    assert not any(re.search(rf"\b({payload})#", line) for line in choosing)
    scans = re.findall(r"ReadSchema: struct<([^>]*(?:<[^>]*>)?[^>]*)>", text)
    assert len(scans) == 2 and sum(bool(re.search(r"embedding|value", scan)) for scan in scans) == 1
