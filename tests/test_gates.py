from __future__ import annotations

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from verdictlake.functions import formatting as fmt
from verdictlake.operators import config, gates, scorecard as sc
from verdictlake.sources.sinks import write_report

DAY = datetime(2024, 1, 1)


def test_rounding_is_half_even(spark):
    values = [0.00005, 0.00025, 0.12345, 0.5, 2 / 3]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(fmt.round4(F.col("x")).alias("r")).collect()
    assert [r.r for r in rows] == [round(v * 10000) / 10000 for v in values] == [0.0, 0.0002, 0.1234, 0.5, 0.6667]


def test_number_texts_equal_python(spark):
    rng = random.Random(1)
    values = [i / 800 for i in range(-900, 900)] + [rng.uniform(-2, 2) for _ in range(2000)] + [0.1235, 0.0, 1.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").select(
        "i", fmt.percent(F.col("x")).alias("p"), fmt.points(F.col("x")).alias("d"),
        fmt.whole_percent(F.abs("x")).alias("w")).orderBy("i").collect()
    assert [r.p for r in rows] == [f"{v * 100:.1f}%" for v in values]
    assert [r.d for r in rows] == [("+" if v >= 0 else "") + f"{v * 100:.1f}pp" for v in values]
    assert [r.w for r in rows] == [f"{abs(v):.0%}" for v in values]


def gate_of(spark, evaluated, rate, baseline, threshold=0.8, least=1, most=0.1):
    totals = spark.createDataFrame([(1, evaluated, 0, rate)], "check_id int, evaluated bigint, passed bigint, pass_rate double")
    settings = spark.createDataFrame([(1, threshold, least, most)],
                                     "check_id int, threshold double, min_scenarios int, max_regression double")
    base = None if baseline is None else spark.createDataFrame(
        [(1, 9, baseline)], "check_id int, baseline_check_id int, baseline_rate double")
    return gates.gate(totals, settings, base).first()


def test_gate_rows(spark):
    close = gate_of(spark, 10, 0.8, 0.9)
    assert close.regression_ok and close.status == "passed" and -close.delta == 0.09999999999999998
    assert gate_of(spark, 10, 0.8, 0.91).status == "failed"
    assert gate_of(spark, 10, 0.8, 0.99, most=None).status == "passed"
    assert gate_of(spark, 0, 0.0, None, threshold=0.0).status == "failed"
    assert gate_of(spark, 4, 1.0, None, least=5).status == "failed"


def test_exit_codes(spark):
    rows = [(s, w, c, i) for s, w, c, i in itertools.product(["passed", "failed"], *[[True, False]] * 3)]
    df = spark.createDataFrame(rows, "s string, w boolean, c boolean, i boolean")
    got = [r.x for r in df.select(gates.exit_code(F.col("s"), F.col("w"), F.col("c"), F.col("i")).alias("x")).collect()]
    assert got == [2 if c else 3 if i else 0 if s == "passed" or w else 1 for s, w, c, i in rows]


def test_suite_without_verdicts(spark):
    rollouts = spark.createDataFrame([(1, 1, 5, "completed")], "rollout_id int, check_id int, scenario_id int, status string")
    none = spark.createDataFrame([], "check_id int, rollout_id int, eval_seq int, passed boolean")
    assert sc.suite_totals(rollouts, none).first().pass_rate == 0.0
    joined = rollouts.join(none.drop("check_id"), "rollout_id", "left")
    assert sc.pooled_pass_rate(joined, ["check_id"]).first().pass_rate is None
    row = sc.scenario_scorecard(rollouts, none).first()
    assert (row.repeats, row.pass_rate) == (0, 0.0)


def test_last_verdict_wins_for_the_scenario_only(spark):
    rollouts = spark.createDataFrame([(1, 1, 5, "completed")], "rollout_id int, check_id int, scenario_id int, status string")
    verdicts = spark.createDataFrame([(1, 1, 2, False), (1, 1, 1, True)],
                                     "check_id int, rollout_id int, eval_seq int, passed boolean")
    card, suite = sc.scenario_scorecard(rollouts, verdicts).first(), sc.suite_totals(rollouts, verdicts).first()
    assert (card.repeats, card.passed) == (1, 0)
    assert (suite.evaluated, suite.passed) == (2, 1)


def test_baseline_newest_without_verdicts_is_no_baseline(spark):
    checks = spark.createDataFrame(
        [(1, 1, "main", "succeeded", DAY), (2, 1, "main", "succeeded", DAY + timedelta(1)),
         (3, 1, "dev", "running", DAY + timedelta(2)), (4, 1, "dev", "running", DAY + timedelta(1)),
         (5, 2, "dev", "running", DAY + timedelta(9))],
        "check_id int, session_id int, branch string, status string, created_at timestamp")
    verdicts = spark.createDataFrame([(1, 4, 3)], "check_id int, evaluated bigint, passed bigint")
    got = gates.baseline_for(checks.withColumn("baseline_branch", F.lit("main")), checks, verdicts).collect()
    # 3 finds check 2, which nobody judged; 4 starts with check 2 and finds 1.
    assert {r.check_id: (r.baseline_check_id, r.baseline_rate) for r in got} == {2: (1, 0.75), 4: (1, 0.75)}


@pytest.mark.parametrize("passed, total, rows, models, action, text", [
    (6, 10, 100, True, "reused", "success rate 60% within 60%-90% band"),
    (9, 10, 100, True, "reused", "success rate 90% within 60%-90% band"),
    (5, 10, 100, True, "generated", "success rate 50% below 60%; regenerating calibrated on 7"),
    (95, 100, 100, True, "generated", "success rate 95% above 90%; regenerating calibrated on 7"),
    (7, 10, 80, True, "generated", "latest dataset has 80 rows; requested 100; reusing session user model (no drift signal)"),
    (7, 10, 80, False, "generated", "latest dataset has 80 rows; requested 100"),
    (0, 0, 100, True, "reused", "no completed quality check to judge by; reusing latest dataset"),
    (0, 0, None, False, "generated", "no datasets in this session yet"),
])
def test_reuse_decision(spark, passed, total, rows, models, action, text):
    sessions = spark.createDataFrame([(1,)], "session_id int")
    datasets = spark.createDataFrame([] if rows is None else [(3, 1, rows, DAY)],
                                     "dataset_id int, session_id int, row_count int, created_at timestamp")
    checks = spark.createDataFrame([(7, 1, "succeeded", DAY), (8, 1, "running", DAY + timedelta(1))],
                                   "check_id int, session_id int, status string, created_at timestamp")
    verdicts = spark.createDataFrame([(7, i < passed) for i in range(total)], "check_id int, passed boolean")
    people = spark.createDataFrame([(1,)] if models else [], "session_id int")
    row = gates.reuse_decision(sessions, datasets, checks, verdicts, people).first()
    assert (row.action, row.reason) == (action, text)


def test_reuse_forced(spark):
    sessions = spark.createDataFrame([(1, True)], "session_id int, reprobe boolean")
    empty = [spark.createDataFrame([], ddl) for ddl in (
        "dataset_id int, session_id int, row_count int, created_at timestamp",
        "check_id int, session_id int, status string, created_at timestamp", "check_id int, passed boolean", "session_id int")]
    row = gates.reuse_decision(sessions, *empty).first()
    assert (row.action, row.probes, row.reason) == ("generated", True, "reprobe requested")


def test_report_sink_refuses_other_columns(spark, tmp_path):
    leaky = spark.createDataFrame([(1, "s", "text")], "version int, session_id string, transcript string")
    with pytest.raises(ValueError, match="transcript"):
        write_report(leaky, str(tmp_path / "out"))


CONFIG_ROWS = [
    ('{"version": 1, "agent": {"entrypoint": "a.py"}}', set()),
    ("{}", {("version", "must be 1"), ("agent.entrypoint", "required (path to your RolloutAgent module)")}),
    ('{"version": "1", "agent": {"entrypoint": " "}}',
     {("version", "expected a number"), ("version", "must be 1"), ("agent.entrypoint", "expected a non-empty string")}),
    ('{"version": 1.5, "agent": []}', {("version", "expected an integer"), ("version", "must be 1"),
                                       ("agent", "expected a mapping"), ("agent.entrypoint", "required (path to your RolloutAgent module)")}),
    ('{"version": 1, "agent": {"entrypoint": "a", "meta": {"x": {}}, "model": 1}}',
     {("agent.model", "unknown key (allowed: entrypoint, meta)")}),
    ('{"version": 1, "agent": {"entrypoint": "a"}, "run": {"max_turns": 1, "repeats": 6, "concurrency": true, '
     '"timeout_minutes": 0.5, "dataset": "DS_1"}}',
     {("run.max_turns", "must be >= 2"), ("run.repeats", "must be <= 5"), ("run.concurrency", "expected a number"),
      ("run.timeout_minutes", "must be >= 1"), ("run.dataset", "expected a ds_… dataset id")}),
    ('{"version": 1, "agent": {"entrypoint": "a"}, "thresholds": {"pass_rate": 1.1, "min_scenarios": null}, '
     '"baseline": {"branch": "", "max_regression": -0.1}}',
     {("thresholds.pass_rate", "must be <= 1"), ("baseline.branch", "expected a non-empty string"),
      ("baseline.max_regression", "must be >= 0")}),
    ('{"version": 1, "agent": {"entrypoint": "a"}, "telemetry": {"redact": {"enabled": null, "patterns": ["a", 1]}}}',
     {("telemetry.redact.enabled", "expected true or false"),
      ("telemetry.redact.patterns", "expected a list of regex strings")}),
    ('{"version": 1, "agent": {"entrypoint": "a"}, "telemetry": {"redact": {"enabled": false, "patterns": ["a"]}}}', set()),
    ('{"version": 1, "agent": {"entrypoint": "a"}, "telemetry": 3, "output": 4}',
     {("telemetry", "expected a mapping"), ("output", "expected a non-empty string")}),
]


def test_config_rules(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CONFIG_ROWS)], "run_id int, raw_config string")
    got = [set() for _ in CONFIG_ROWS]
    for row in config.config_violations(df).collect():
        got[row.run_id].add((row.path, row.issue))
    assert got == [want for _, want in CONFIG_ROWS]


def test_policy(spark):
    runs = spark.createDataFrame([(1, 1, 0.5, 9), (2, 1, None, 2), (3, 2, None, 4), (4, 2, 0.9, 4)],
                                 "run_id int, session_id int, pass_rate double, concurrency int")
    policy = spark.createDataFrame([(1, 0.8, 4, 0.7)],
                                   "session_id int, pass_rate_floor double, max_concurrency int, default_pass_rate double")
    rows = {r.run_id: r for r in config.apply_policy(runs, policy).collect()}
    assert (rows[1].pass_rate, rows[1].concurrency, len(rows[1].warnings)) == (0.8, 4, 2)
    assert (rows[2].pass_rate, rows[2].concurrency, len(rows[2].warnings)) == (0.8, 2, 2)
    assert rows[3].config_error and rows[3].pass_rate is None
    assert (rows[4].pass_rate, rows[4].warnings, rows[4].config_error) == (0.9, [], None)
