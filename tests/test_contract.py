"""Rescued fields, stored grains, and every family of operators on contract tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from verdictlake.functions.redaction import redact_secrets
from verdictlake.operators import replay, runs, scorecard as sc, usage, validation
from verdictlake.schemas import SCHEMAS
from verdictlake.sources import grains, readers


def lines(path, rows):
    path.mkdir()
    (path / "a.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def test_rescued_lines(spark, tmp_path):
    rows = [{"run_id": "a", "seq": 1, "stage": "s"}, {"run_id": "b", "seq": "x", "new": {"k": [1, None]}}, {"run_id": 7, "seq": 2.5, "stage": None}, "no json", "[1]", "", "  ",
            {"run_id": "c", "seq": None, "created_at": "never"}, {"run_id": "d", "seq": 3, "created_at": "2024-01-01T00:00:00Z"}, {}]
    got = readers.read_rescued(spark, "run_events", lines(tmp_path / "x", rows)).collect()
    shown = [(r.run_id, r.seq, r.stage, json.loads(r["_rescued"]) if r["_rescued"] else None) for r in got]
    assert shown == [("a", 1, "s", None), ("b", None, None, {"seq": "x", "new": {"k": [1, None]}}), ("7", None, None, {"seq": 2.5}), (None, None, None, {"_line": "no json"}),
                     (None, None, None, {"_line": "[1]"}), ("c", None, None, {"created_at": "never"}), ("d", 3, None, None), (None, None, None, None)]


def test_rescued_columns(spark):
    frame = spark.createDataFrame([("1", 2, "x", [1], None), ("q", None, None, None, "n")], "a string, b int, c string, d array<int>, `new.er` string")
    known = StructType.fromDDL("a int, b bigint, d array<string>, z string")
    got = [(r.a, r.b, r.d, json.loads(r.more) if r.more else None) for r in readers.project_known(frame, known, "more").collect()]
    assert got == [(1, 2, None, {"c": "x", "d": [1]}), (None, None, None, {"new.er": "n", "a": "q"})]
    assert readers.project_known(frame, known).columns == ["a", "b", "d"]
    same = readers.project_known(frame.select("b"), StructType.fromDDL("b int"), "more").collect()
    assert [tuple(r) for r in same] == [(2, None), (None, None)]


def test_stored_grains_join_without_exchange(spark):
    rollouts = spark.range(4000).select((F.col("id") % 50).alias("check_id"), F.col("id").alias("rollout_id"))
    verdicts = spark.range(6000).select((F.col("id") % 4000 % 50).alias("check_id"), (F.col("id") % 4000).alias("rollout_id"), F.col("id").alias("eval_seq"), (F.col("id") % 3 > 0).alias("passed"))
    plain = sc.attach_verdicts(rollouts, verdicts)
    stored = sc.attach_verdicts(grains.store_by_grain(rollouts, "r", buckets=4), grains.store_by_grain(verdicts, "v", buckets=4))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
        assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def empty(spark):
    return {name: spark.createDataFrame([], StructType.fromDDL(ddl)) for name, ddl in SCHEMAS.items()}


def test_operators_on_empty_contract_tables(empty):
    t = empty
    rollouts, evaluations = t["rollouts"], t["evaluations"]
    rows = evaluations.join(rollouts.select("check_id", "rollout_id", "scenario_id"), ["check_id", "rollout_id"]).withColumn("ord", F.col("eval_seq"))
    meta = rows.join(t["scenarios"].select("scenario_id", "title", "task_family"), "scenario_id", "left")
    replayed = replay.tool_replay(t["tool_events"], t["sandboxes"])
    frames = [
        sc.scenario_scorecard(rollouts, evaluations), sc.suite_totals(rollouts, evaluations), sc.unjudged_rollouts(rollouts, evaluations),
        sc.fold_scenario_meta(meta, redact_secrets), sc.issue_frequency(rows), sc.agent_compare(rollouts, evaluations), sc.agents_side_by_side(rollouts, evaluations),
        sc.family_scorecard(rollouts, evaluations, t["scenarios"]), sc.latest_check_summary(t["quality_checks"], evaluations),
        sc.list_datasets(t["datasets"]), sc.dataset_rows(t["dataset_rows"], t["scenarios"]), sc.list_user_models(t["user_models"]),
        replayed, replay.final_sandbox_state(replayed, t["sandboxes"]), replay.first_call_fault(t["tool_events"], t["sandboxes"]), replay.tool_call_stats(t["tool_events"]),
        usage.usage_by_key(t["requests"], "24h", __import__("datetime").datetime(2024, 1, 2)), usage.tier_scorecard(t["tier_results"]),
        runs.recent_activity(t["requests"]), runs.next_cursors(t["run_events"]), validation.validation_validity(t["validations"]),
        readers.chat_messages(t["turns"]), readers.flatten_transcripts(t["transcripts"]), readers.flatten_tool_events(t["transcripts"])]
    # A rollup has a grand total even of nothing.
    assert [len(f.collect()) for f in frames if "level" not in f.columns] == [0] * (len(frames) - 1)


def test_contract_rows_end_to_end(spark, tmp_path):
    rollouts = [{"rollout_id": f"r{i}", "check_id": "c", "scenario_id": f"s{i % 2}", "status": "completed", "agent_meta": '{"name": "a", "version": "1", "model": "m"}', "later": 1} for i in range(4)]
    judged = [{"check_id": "c", "rollout_id": f"r{i}", "eval_seq": 0, "passed": i > 1, "states": [], "judge": '{"issues": ["late"]}'} for i in range(3)]
    played = readers.read_table(spark, "rollouts", lines(tmp_path / "r", rollouts), "json")
    verdicts = readers.read_table(spark, "evaluations", lines(tmp_path / "e", judged), "json")
    card = {r.scenario_id: (r.repeats, r.passed, r.pass_rate) for r in sc.scenario_scorecard(played, verdicts).collect()}
    assert card == {"s0": (2, 1, 0.5), "s1": (1, 0, 0.0)}
    rows = verdicts.join(played.select("check_id", "rollout_id", "scenario_id"), ["check_id", "rollout_id"])
    assert [(r.issue, r.findings, r.scenarios) for r in sc.issue_frequency(rows).collect()] == [("late", 3, 2)]
    wide = sc.agents_side_by_side(played, verdicts, ["check_id"]).first()
    assert wide["a@1 (m)"] == pytest.approx(1 / 3) and wide[sc.OTHER_AGENTS] is None
