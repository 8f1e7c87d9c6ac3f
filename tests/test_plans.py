"""Plan shape: pushed filters, pruned columns, no cross joins, no hot windows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from verdictlake.operators import runs as run_ops, scorecard as sc
from verdictlake.plans import bindings as fx

# These write to the shared folder when they are built.
EAGER = {"read_transcripts", "read_tool_events", "write_report", "idempotent_turns"}
LAZY = sorted(n for n in entry_point.queries() if not n.startswith("stream_") and n not in EAGER)
# One row per family or one global count: bounded by what was aggregated before.
SMALL_SINGLE = {"voice_stats", "calibration_weights", "sample_scenarios", "default_dataset"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_single_task(spark, sf_dir, name):
    plan = plan_of(entry_point.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in SMALL_SINGLE:
        assert "SinglePartition" not in plan


def test_redaction_and_config_need_no_shuffle(spark, sf_dir):
    for name in ("redact_pii", "redact_secrets_custom", "redact_pii_json", "config_violations", "ingest_seeds", "format_rate"):
        assert "Exchange" not in plan_of(entry_point.queries()[name](spark, sf_dir)), name


def test_text_redaction_stays_in_the_jvm(spark, sf_dir):
    assert "Python" not in plan_of(entry_point.queries()["redact_pii"](spark, sf_dir))


def test_filters_reach_the_scan(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("type"), F.col("o_custkey").alias("session_id"),
        F.col("o_orderdate").alias("created_at"))
    plan = plan_of(run_ops.list_runs(rows, run_type="F", session=3, limit=5))
    assert "EqualTo(o_orderstatus,F)" in plan and "EqualTo(o_custkey,3)" in plan
    assert "TakeOrderedAndProject" in plan


def test_columns_are_pruned(spark, sf_dir):
    plan = plan_of(sc.pooled_pass_rate(fx.evaluations(spark, sf_dir), ["check_id"]))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>", plan)


def test_top_rows_are_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(entry_point.queries()["weakest_scenarios"](spark, sf_dir))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")  # final and partial
