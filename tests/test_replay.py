from __future__ import annotations

import hashlib
import json
import random

from pyspark.sql import functions as F

from verdictlake.functions.canonical import call_hash
from verdictlake.operators import replay

EVENTS = "rollout_id int, seq int, name string, input string, external boolean"
BOXES = "rollout_id int, seed bigint, fail_tools array<string>, version bigint"


def digest(name, value, version, seed):
    return hashlib.sha256(json.dumps([name, value, version, seed], sort_keys=True).encode()).hexdigest()[:8]


def twin(calls, seed, fail_tools, version):
    """Independent replay of one rollout's calls in order."""
    open_faults, out = set(fail_tools), []
    for name, value, external in calls:
        hit = name in open_faults
        open_faults.discard(name)
        if external:
            out.append((version, hit, None, None))
        elif hit:
            out.append((version, hit, None, f"{name} is unavailable"))
        else:
            out.append((version, hit, digest(name, value, version, seed), None))
            version += 1
    return out


def test_literal_hash(spark):
    row = spark.range(1).select(call_hash(F.lit("n"), F.lit('{"k": 1}'), F.lit(0), F.lit(7)).alias("h")).first()
    assert row.h == "ca2861ea"


def test_fault_then_ok_at_the_same_version(spark):
    events = spark.createDataFrame([(1, 0, "n", '{"k": 1}', False), (1, 1, "n", '{"k": 1}', False)], EVENTS)
    boxes = spark.createDataFrame([(1, 7, ["n"], 0)], BOXES)
    rows = replay.tool_replay(events, boxes).orderBy("seq").collect()
    assert [(r.version, r.error, r.result_id) for r in rows] == [(0, "n is unavailable", None), (0, None, "ca2861ea")]


def test_equals_twin(spark):
    rng = random.Random(5)
    events, boxes, want = [], [], {}
    for rollout in range(30):
        size = 9000 if rollout == 0 else rng.randrange(1, 30)
        calls = [(rng.choice("abc"), {"z": rng.randrange(9), "é": [1.0, {"b": None}]}, rng.random() < 0.2)
                 for _ in range(size)]
        seed, fail, version = rng.randrange(1000), rng.sample("abcd", rng.randrange(3)), rng.randrange(4)
        boxes.append((rollout, seed, fail, version))
        for seq, (call, expected) in enumerate(zip(calls, twin(calls, seed, fail, version))):
            events.append((rollout, seq, call[0], json.dumps(call[1], separators=(",", ":")), call[2]))
            want[rollout, seq] = expected
    rng.shuffle(events)
    rows = replay.tool_replay(spark.createDataFrame(events, EVENTS), spark.createDataFrame(boxes, BOXES)).collect()
    assert {(r.rollout_id, r.seq): (r.version, r.is_fault, r.result_id, r.error) for r in rows} == want


class Sandbox:
    """One rollout's sandbox, call by call, set anew where a turn brings a row."""

    def __init__(self):
        self.seed, self.open, self.state, self.segment = 0, set(), {}, None

    def refresh(self, turn, seed, fail_tools, state):
        self.seed, self.open, self.state, self.segment = seed, set(fail_tools), dict(state), turn

    def call(self, name, value, external, is_error):
        hit = name in self.open and (not external or is_error)
        if hit:
            self.open.discard(name)
        version = self.state.get("version", 0)
        if external:
            return version, hit, None, None
        if hit:
            return version, hit, None, f"{name} is unavailable"
        result = digest(name, value, version, self.seed)
        self.state.update({"version": version + 1, f"last_{name}": result})
        return version, hit, result, None


def refreshed_rollouts(rng, rollouts=25):
    events, boxes, want, states = [], [], {}, {}
    for rollout in range(rollouts):
        box, turn = Sandbox(), 0
        plans = {t: (rng.randrange(99), rng.sample("abcd", rng.randrange(3)),
                     {"version": rng.randrange(9), "last_a": "old", "city": "x", "n": rng.choice([1, 2.5, None, True, [1, "é"]])} if rng.random() < 0.8 else {})
                 for t in range(12) if rng.random() < 0.4}
        if rollout % 5 == 0:
            plans.pop(0, None)  # calls before the first row
        elif rollout % 5 == 1:
            plans[0] = (7, ["a"], {"version": 2})
        for seq in range(9000 if rollout == 1 else rng.randrange(1, 60)):
            while turn < 12 and (seq == 0 or rng.random() < (0.002 if rollout == 1 else 0.2)):
                if turn in plans:
                    box.refresh(turn, *plans[turn])
                turn += 1
            name, value, external, is_error = rng.choice("abc"), {"z": rng.randrange(9)}, rng.random() < 0.3, rng.random() < 0.3
            events.append((rollout, seq, turn - 1, name, json.dumps(value), external, is_error))
            want[rollout, seq] = box.call(name, value, external, is_error)
        for t in range(turn, 12):  # rows after the last call
            if t in plans:
                box.refresh(t, *plans[t])
        boxes += [(rollout, t, seed, fail, json.dumps(state)) for t, (seed, fail, state) in plans.items()]
        if plans:
            states[rollout] = {"version": 0, **box.state}
    return events, boxes, want, states


def test_sandboxes_set_anew_each_turn(spark):
    rng = random.Random(11)
    events, boxes, want, states = refreshed_rollouts(rng)
    rng.shuffle(events), rng.shuffle(boxes)
    calls = spark.createDataFrame(events, "rollout_id int, seq int, turn_idx int, name string, input string, external boolean, is_error boolean").repartition(5)
    rows = spark.createDataFrame(boxes, "rollout_id int, turn_idx int, seed bigint, fail_tools array<string>, state string")
    replayed = replay.tool_replay(calls, rows)
    got = {(r.rollout_id, r.seq): (r.version, r.is_fault, r.result_id, r.error) for r in replayed.collect()}
    assert got == want
    assert {(r.rollout_id, r.seq): r.is_fault for r in replay.first_call_fault(calls, rows).collect()} == {k: v[1] for k, v in want.items()}
    kept = {}
    for r in replay.final_sandbox_state(replayed, rows).collect():
        kept.setdefault(r.rollout_id, {})[r.key] = r.value
    shown = {i: {k: v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":")) for k, v in s.items()} for i, s in states.items()}
    assert kept == shown


def test_replay_on_empty_tables(spark):
    calls = spark.createDataFrame([], "rollout_id int, seq int, turn_idx int, name string, input string, external boolean")
    rows = spark.createDataFrame([(1, 0, 7, ["a"], '{"version": 3, "k": "v"}')], "rollout_id int, turn_idx int, seed bigint, fail_tools array<string>, state string")
    replayed = replay.tool_replay(calls, rows)
    assert replayed.collect() == []
    assert sorted((r.key, r.value) for r in replay.final_sandbox_state(replayed, rows).collect()) == [("k", "v"), ("version", "3")]


def test_external_reports_are_not_compared(spark):
    reported = spark.createDataFrame([(1, 0, "n", "x", None, True), (1, 1, "n", "x", None, False)],
                                     "rollout_id int, seq int, name string, result_id string, error string, external boolean")
    expected = spark.createDataFrame([(1, 0, "y", None), (1, 1, "y", None)],
                                     "rollout_id int, seq int, result_id string, error string")
    assert [r.seq for r in replay.replay_mismatches(reported, expected).collect()] == [1]


def test_turns_of_one_hot_instant(spark):
    """Many calls and turns at one instant: cut by place, order kept."""
    at = F.timestamp_micros(F.lit(1_700_000_000_000_000))
    turns = spark.range(300).select(F.lit(1).alias("rollout_id"), F.col("id").alias("turn_idx"), at.alias("at"))
    later = F.when(F.col("id") < 900, at).otherwise(F.timestamp_micros(1_700_000_000_000_000 + F.col("id")))
    events = spark.range(1000).select(F.lit(1).alias("rollout_id"), F.col("id").alias("seq"), later.alias("at"))
    got = replay.assign_turn_idx(turns, events, block_rows=50).collect()
    assert sorted(r.seq for r in got) == list(range(1000)) and {r.turn_idx for r in got} == {299}


def test_event_before_any_turn_is_on_turn_zero(spark):
    turns = spark.createDataFrame([(1, 0, "2024-01-01 10:00:00"), (1, 1, "2024-01-02 10:00:00")],
                                  "rollout_id int, turn_idx int, at string").withColumn("at", F.to_timestamp("at"))
    events = spark.createDataFrame([(1, 0, "2024-01-01 09:00:00"), (1, 1, "2024-01-01 10:00:00"), (1, 2, "2024-01-03 00:00:00")],
                                   "rollout_id int, seq int, at string").withColumn("at", F.to_timestamp("at"))
    got = replay.assign_turn_idx(turns, events).orderBy("seq").collect()
    assert [r.turn_idx for r in got] == [0, 0, 1]
