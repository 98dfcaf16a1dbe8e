"""Shapes of the physical plans: what must hold at any size."""

import re

import pytest

from adlumen.queries import all_queries as queries

#: These write or stream while they are built.
EAGER = {"repartition_verified", "stream_ingest", "stream_dedup", "stream_window_counts"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries()) - EAGER))
def test_no_products_no_python_no_single_task(spark, small, name):
    plan = physical(queries()[name](spark, small))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF", "InPandas"):
        assert node not in plan
    # a single-partition exchange carries aggregates or bucket totals, not rows
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1:i + 4])
            assert "partial_" in below or "HashAggregate(keys=[_bucket" in below or "Limit" in below, line


def scans(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def columns(schema):
    return sorted(field.split(":")[0] for field in schema.split(",") if field)


@pytest.mark.parametrize("name, expected", [
    ("campaign_kpis", ["event_type", "props", "value"]),
    ("rebuild_mode", ["ts"]),
    ("partition_specs", ["ts"]),
    ("compaction_plan", ["o_orderdate", "o_totalprice"]),
    ("access_counts", ["l_orderkey", "l_shipdate"]),
    ("dsp_validation", ["l_orderkey", "l_partkey", "l_shipdate", "l_tax"]),
    ("email_check", ["doc_id", "text"])])
def test_only_needed_columns_are_read(spark, small, name, expected):
    assert {tuple(columns(s)) for s in scans(physical(queries()[name](spark, small)))} == {tuple(expected)}


@pytest.mark.parametrize("name, pushed", [
    ("campaign_kpis", "In(event_type"), ("access_counts", "GreaterThanOrEqual(l_shipdate"),
    ("email_check", "StringContains(text,@)"), ("user_features", "In(event_type")])
def test_filters_reach_the_scan(spark, small, name, pushed):
    assert pushed in physical(queries()[name](spark, small)).replace("*", "")


@pytest.mark.parametrize("name", ["dedup_events", "top_ads"])
def test_rank_limits_before_the_shuffle(spark, small, name):
    plan = physical(queries()[name](spark, small))
    assert re.search(r"WindowGroupLimit .* Partial", plan)


@pytest.mark.parametrize("name", ["nested_report", "rfm_thresholds", "rfm_tiers"])
def test_branches_share_one_scan(spark, small, name):
    df = queries()[name](spark, small)
    df.collect()
    final = physical(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    # where the cut points read the log, the rest of the plan reuses their shuffle
    assert final.count("FileScan") <= 1
