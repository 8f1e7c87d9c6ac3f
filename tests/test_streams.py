"""Streams over written tables."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from verdictlake.operators import replay
from verdictlake.plans.streaming_queries import as_stream
from verdictlake.session import shared_folder
from verdictlake.streaming import feeds, stateful


def test_rows_without_a_time_enter_the_stream(spark):
    rows = spark.range(40).selectExpr("id", "CASE WHEN id % 4 > 0 THEN timestamp_seconds(id) END AS at")
    out = feeds.run_available(as_stream(rows, spark, "null-times", "at"), spark, "null-times-out")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))


@pytest.mark.parametrize("files", [1, 2, 6])
def test_late_requests_are_counted(spark, files):
    session = stateful.state_session(spark)
    rows = [(0, 10 * i, 200) for i in range(12)] + [(1, 7200 + i, 500) for i in range(12)] + [(2, 5, 200), (2, 6, 500)] + [(2, 7300 + i, 200) for i in range(10)]
    frame = spark.createDataFrame(rows, "stretch int, at long, status int").withColumn("created_at", F.timestamp_seconds("at")).drop("at")
    counted = stateful.stream_usage(as_stream(frame, session, "late-usage", stretch="stretch", files=files), 3600, "1 minute")
    got = feeds.summed(spark, feeds.run_available(counted, session, "late-usage-out"), ["bucket_ms"]).collect()
    # The first hour is over when the third stretch comes: its two rows are late.
    assert {r.bucket_ms: (r.requests, r.errors, r.late) for r in got} == {0: (12, 0, 2), 7_200_000: (22, 12, 0)}


@pytest.mark.parametrize("files", [1, 6])
def test_resent_and_late_verdicts(spark, files):
    session = stateful.state_session(spark)
    first = [(0, 1, r, 0, r % 2 == 0, 100 + r) for r in range(10)]
    again = [(1, *v[1:]) for v in first[:4]] + [(1, 1, 50 + r, 0, True, 5000 + r) for r in range(6)]
    much_later = [(2, *v[1:]) for v in first[:3]] + [(2, 1, 50, 0, True, 5000), (2, 1, 50, 1, False, 5001), (2, 2, 7, 0, None, 9000)]
    frame = spark.createDataFrame(first + again + much_later, "stretch int, check_id int, rollout_id int, eval_seq int, passed boolean, s long").withColumn("at", F.timestamp_seconds("s"))
    counted = stateful.stream_pass_rate(as_stream(frame.drop("s"), session, "resent", stretch="stretch", files=files), wait_seconds=3600)
    got = feeds.summed(spark, feeds.run_available(counted, session, "resent-out"), ["check_id"]).collect()
    assert {r.check_id: (r.evaluated, r.passed, r.resent, r.late) for r in got} == {1: (17, 11, 5, 3), 2: (1, 0, 0, 0)}


@pytest.mark.parametrize("files", [1, 6])
def test_calls_behind_a_gap_are_released(spark, files):
    session = stateful.state_session(spark)

    def call(rollout, seq, at, **more):
        row = {"rollout_id": rollout, "seq": seq, "name": "n", "input": '{"k": 1}', "segment": 0, "seed": 7, "planted": ["n"], "start": 0, "external": False,
               "result_id": "wrong", "error": None, "s": at}
        return {**row, **more}
    rows = [call(1, s, 100 + s) for s in (0, 1, 3, 4)] + [call(2, s, 100 + s, segment=s // 2, start=9 * (s // 2)) for s in range(4)] + [call(3, 0, 9000), call(3, 2, 9001)]
    frame = spark.createDataFrame(rows, "rollout_id int, seq int, name string, input string, segment int, seed long, planted array<string>, start long, external boolean, "
                                        "result_id string, error string, s long").withColumn("at", F.timestamp_seconds("s")).drop("s")
    checked = stateful.stream_replay_check(as_stream(frame, session, "gaps", "at", files=files))
    got = {(r.rollout_id, r.seq): (r.want_id, r.want_error, r.after_gap) for r in spark.read.parquet(feeds.run_available(checked, session, "gaps-out")).collect()}
    calls = frame.select("rollout_id", "seq", F.col("segment").alias("turn_idx"), "name", "input")
    boxes = spark.createDataFrame([(r, t, 7, ["n"], json.dumps({"version": 9 * t})) for r in (1, 2, 3) for t in (0, 1)], "rollout_id int, turn_idx int, seed long, fail_tools array<string>, state string")
    want = {(r.rollout_id, r.seq): (r.result_id, r.error) for r in replay.tool_replay(calls, boxes).collect()}
    # Nothing is later than rollout 3, so what waits there still waits.
    assert {k: v[:2] for k, v in got.items()} == {k: v for k, v in want.items() if k != (3, 2)}
    assert {k for k, v in got.items() if v[2]} == {(1, 3), (1, 4)}


def test_status_of_a_quiet_run_ends(spark):
    session = stateful.state_session(spark)
    rows = [(0, 1, 1, "running", 10), (0, 2, 1, "succeeded", 10), (0, 2, 2, "running", 11), (1, 3, 1, "running", 99_999), (2, 1, 2, "running", 100_000), (2, 3, 2, "failed", 100_001)]
    frame = spark.createDataFrame(rows, "stretch int, run_id int, seq long, status string, s long").withColumn("created_at", F.timestamp_seconds("s")).drop("s")
    out = feeds.run_available(stateful.stream_run_status(as_stream(frame, session, "quiet", stretch="stretch", files=1), keep_seconds=3600), session, "quiet-out", "update")
    got = {r.run_id: (r.status, r.last_seq) for r in feeds.latest_update(spark, out, ["run_id"]).collect()}
    assert got == {1: ("running", 2), 2: ("succeeded", 2), 3: ("failed", 2)}


def test_two_rows_of_one_batch_are_ordered(spark, tmp_path):
    rows = spark.createDataFrame([("a", "running", 0, 0), ("a", "timed_out", 1, 0), ("b", "x", 0, 1), ("b", "y", 0, 0)], "run_id string, status string, step int, batch int")
    rows.write.partitionBy("batch").parquet(str(tmp_path / "o"))
    assert {r.run_id: r.status for r in feeds.latest_update(spark, str(tmp_path / "o"), ["run_id"], ["step"]).collect()} == {"a": "timed_out", "b": "x"}


def test_verdicts_are_counted_many_checks_at_a_time(spark):
    """Late verdicts that never came before are late, verdicts without a time are not."""
    session = stateful.state_session(spark)
    first = spark.range(2_000).selectExpr("0 AS stretch", "id AS check_id", "id * 10 AS rollout_id", "0 AS eval_seq", "id % 2 = 0 AS passed", "timestamp_seconds(100 + id % 7) AS at")
    odd = spark.sql("""SELECT * FROM VALUES (1, 1L, 10L, 0, false, timestamp_seconds(101)), (1, 1L, 11L, 0, true, timestamp_seconds(9000)), (2, 1L, 12L, 0, true, timestamp_seconds(105)),
                       (2, 2L, 20L, 0, true, timestamp_seconds(102)), (2, 3L, NULL, 0, true, NULL), (2, NULL, 7L, 0, NULL, timestamp_seconds(9000)) AS t(stretch, check_id, rollout_id, eval_seq, passed, at)""")
    counted = stateful.stream_pass_rate(as_stream(first.unionByName(odd), session, "many", stretch="stretch", files=1), wait_seconds=3600)
    got = {r.check_id: (r.evaluated, r.passed, r.resent, r.late) for r in feeds.summed(spark, feeds.run_available(counted, session, "many-out"), ["check_id"]).collect()}
    assert len(got) == 2_001 and got[0] == (1, 1, 0, 0) and got[9] == (1, 0, 0, 0)
    assert got[1] == (2, 1, 1, 1) and got[2] == (1, 1, 0, 1) and got[3] == (2, 1, 0, 0) and got[None] == (1, 0, 0, 0)


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(where, f)) for where, _, files in os.walk(folder) for f in files)


def test_verdicts_take_little_disk(spark):
    """known verdicts are kept packed, and a stream's input is written once and not shuffled."""
    session = stateful.state_session(spark)
    rows = spark.range(60_000).selectExpr("int(id % 3) AS stretch", "id div 4 AS check_id", "id AS rollout_id", "xxhash64(id) AS eval_seq", "id % 2 = 0 AS passed",
                                          "timestamp_seconds(86400 * (1 + id % 300)) AS at")
    stream = as_stream(rows, session, "packed", stretch="stretch", files=None)
    out = feeds.run_available(stateful.stream_pass_rate(stream, wait_seconds=400 * 86400, shards=8), session, "packed-out")
    folder = shared_folder(spark)
    assert not [f for f in os.listdir(folder) if f.startswith("packed-") and f.endswith("-rows")]
    assert _bytes(f"{out[:-4]}/log/state") < 24 * 60_000
    got = feeds.summed(spark, out, ["check_id"]).agg(F.sum("evaluated"), F.sum("passed"), F.sum("resent"), F.sum("late")).first()
    assert tuple(got) == (60_000, 30_000, 0, 0)


@pytest.mark.parametrize("files", [2, None])
def test_a_micro_batch_holds_one_stretch(spark, files):
    session = stateful.state_session(spark)
    rows = spark.createDataFrame([(0, 1), (2, 2), (2, 3)], "stretch int, id int")
    out = feeds.run_available(as_stream(rows, session, "thin", stretch="stretch", files=files).withColumn("batch", F.lit(0)), session, "thin-out", "update")
    assert sorted((r.id, r.batch) for r in spark.read.option("basePath", out).parquet(out).select("id", "batch").collect()) == [(1, 0), (2, 2), (3, 2)]


def test_verdicts_of_many_micro_batches(spark):
    """chunks of state are merged and forgotten, and no verdict is counted twice
    that comes again a micro-batch later, whatever the types of its key."""
    session = stateful.state_session(spark)
    sent = spark.range(100).selectExpr("int(id div 10) AS stretch", "id", "id div 10 AS n")
    rows = sent.unionByName(sent.selectExpr("stretch + 1 AS stretch", "id", "n")).selectExpr(
        "stretch", "id AS check_id", "CASE WHEN id % 5 > 0 THEN id END AS rollout_id", "struct(id, 0.5D * id AS half) AS eval_seq", "id % 2 = 0 AS passed", "timestamp_seconds(1000 * (1 + n)) AS at")
    stream = as_stream(rows, session, "chunks", batches=10, stretch="stretch", files=None)
    counted = stateful.stream_pass_rate(stream, wait_seconds=8500, shards=1)
    got = feeds.summed(spark, feeds.run_available(counted, session, "chunks-out"), ["check_id"]).collect()
    assert {r.check_id: (r.evaluated, r.passed, r.resent, r.late) for r in got} == {i: (1, int(i % 2 == 0), int(i < 90), 0) for i in range(100)}


def test_events_without_a_run_stay_apart(spark):
    session = stateful.state_session(spark)
    frame = spark.sql("SELECT 0 AS stretch, CASE WHEN id % 3 > 0 THEN id % 3 END AS run_id, id AS seq, CASE WHEN id = 57 THEN 'failed' ELSE 'running' END AS status, "
                      "timestamp_seconds(100 + id) AS created_at FROM range(60)")
    out = feeds.run_available(stateful.stream_run_status(as_stream(frame, session, "no-run", stretch="stretch", files=1), keep_seconds=3600), session, "no-run-out", "update")
    got = {r.run_id: (r.status, r.last_seq) for r in feeds.latest_update(spark, out, ["run_id"]).collect()}
    assert got == {None: ("failed", 57), 1: ("running", 58), 2: ("running", 59)}
