"""What the plans must and must not hold, whatever the data's size."""

import re

import pytest
from oracle import data_dir

from homeload.operators import ordered
from homeload.queries import QUERIES

SF = data_dir("0.001")
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_") and n not in ("sinks_roundtrip", "checkpoint_table"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert banned not in plan


def test_scans_read_only_what_is_used(spark):
    plan = plan_of(QUERIES["seasonal_hourly_profile"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>", plan)
    assert "partial_avg" in plan and plan.count("Exchange") == 1
    plan = plan_of(QUERIES["usage_by_member"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("group", [["g"], []])
def test_chunked_windows_shuffle_the_rows_once(spark, group):
    """Without broadcasts the big side meets the chunk totals in the partitioning it already has."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.read.parquet(f"{SF}/events.parquet").selectExpr("event_id", "event_type AS g", "event_id div 100 AS block")
        plan = plan_of(ordered.running_number(df, group, ["event_id"], "n", ["block"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan.split("SortMergeJoin")[1].split("\n")
    # rows: one exchange; chunk totals: aggregate, window and join exchange
    assert sum("Exchange hashpartitioning" in line for line in left) <= 4
    assert "SinglePartition" not in plan or group == []


def test_rules_need_no_shuffle(spark):
    from homeload.plans import audit
    from homeload.queries.audit import family_docs

    docs = family_docs(spark.read.parquet(f"{SF}/customer.parquet"))
    assert "Exchange" not in plan_of(audit.document_family_findings(docs, ["c_custkey"]))
