from __future__ import annotations

import json

from pyspark.sql import functions as F

from verdictlake.functions import provenance as pv
from verdictlake.operators import issues, judging, runs as run_ops
from verdictlake.sources import readers


def test_nested_documents(spark, tmp_path):
    doc = {"rollout_id": "r1", "newer": {"x": 1}, "transcript": [
        {"role": "user", "content": "hi"}, {"role": "agent", "content": "yo", "audio_url": "u"}, {"role": "judge", "content": "no"}],
        "tool_events": [{"name": "a", "input": '{"k": 1}', "is_error": True, "seq": 5}, {"name": "b", "turn_idx": 1, "external": True}]}
    part = {"rollout_id": "r1", "first_turn": 3, "transcript": [{"role": "user", "content": "more"}]}
    (tmp_path / "d.json").write_text(json.dumps(doc) + "\n" + json.dumps(part) + "\n")
    turns = readers.read_transcripts(spark, str(tmp_path)).orderBy("turn_idx").collect()
    assert [(t.turn_idx, t.role, t.role_ok) for t in turns] == [
        (0, "user", True), (1, "agent", True), (2, "judge", False), (3, "user", True)]
    events = readers.read_tool_events(spark, str(tmp_path)).orderBy("name").collect()
    assert [(e.seq, e.turn_idx, e.name, e.is_error, e.external) for e in events] == [
        (5, None, "a", True, False), (1, 1, "b", False, True)]


def test_unknown_columns_are_dropped_and_missing_ones_are_null(spark, tmp_path):
    spark.createDataFrame([("s1", "n", 3)], "session_id string, name string, extra int").write.parquet(str(tmp_path / "t"))
    row = readers.read_table(spark, "sessions", str(tmp_path / "t")).first()
    assert row.asDict() == {"session_id": "s1", "name": "n", "created_at": None, "last_activity": None}


def test_long_conversations_continue_on_pages(spark):
    turns = spark.range(2500).select(F.lit("r").alias("rollout_id"), F.col("id").cast("int").alias("turn_idx"),
                                     F.lit("agent").alias("role"), F.col("id").cast("string").alias("content"))
    pages = readers.chat_messages(turns).orderBy("page").collect()
    assert [len(p.messages) for p in pages] == [1000, 1000, 500]
    assert [m.content for p in pages for m in p.messages] == [str(i) for i in range(2500)]
    assert pages[0].messages[0].role == "assistant"


def test_file_suffixes(spark):
    names = {"a.wav": True, "x/B.PDF": True, "a.txt": False, ".wav": False, "dir.pdf/readme": False, "a.tar.docx": True,
             "say hello.": False, "wav": False, "x/.pdf": False}
    df = spark.createDataFrame([(n,) for n in names], "p string")
    assert {r.p: r.x for r in df.select("p", readers.is_file_name(F.col("p")).alias("x")).collect()} == names


def test_seed_files_and_chunks(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"\x00\x01")
    row = readers.read_seed_files(spark, str(tmp_path)).first()
    assert (row.filename, bytes(row.bytes), row.length) == ("a.pdf", b"\x00\x01", 2)
    seeds = spark.createDataFrame([(1, "abcdefg"), (2, "")], "seed_id int, text string")
    got = [(r.seed_id, r.chunk, r.content) for r in readers.seed_chunks(seeds, 3).orderBy("seed_id", "chunk").collect()]
    assert got == [(1, 0, "abc"), (1, 1, "def"), (1, 2, "g"), (2, 0, "")]


def test_provenance(spark):
    rows = [("feat", "12/merge", None, "o/r", "7"), ("feat", "x/merge", None, "o/r", "7"), ("", "12/merge", "https://g", "o/r", "7"),
            (None, "main", None, None, "7")]
    df = spark.createDataFrame(rows, "head_ref string, ref_name string, server string, repo string, ci_run_id string")
    got = [(r.branch, r.pr, r.run_url) for r in pv.ci_provenance(df).collect()]
    assert got == [("feat", 12, "https://github.com/o/r/actions/runs/7"), ("feat", None, "https://github.com/o/r/actions/runs/7"),
                   ("12/merge", None, "https://g/o/r/actions/runs/7"), ("main", None, None)]


def test_repo_slug(spark):
    urls = {"https://host/o/r.git": "o/r", "git@host:o/r.git": "o/r", "https://host/o/r": "o/r", "nothing": None, "ssh://git@h/o/r.x": "o/r.x"}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert {r.u: r.s for r in df.select("u", pv.repo_slug(F.col("u")).alias("s")).collect()} == urls


def test_event_lines(spark):
    rows = [("gen", "done", '{"n": 3, "ok": true, "why": null, "who": "x y"}'), ("gen", "idle", "{}"), ("gen", "none", None)]
    df = spark.createDataFrame(rows, "s string, m string, d string")
    got = [r.x for r in df.select(run_ops.event_line(F.col("s"), F.col("m"), F.col("d")).alias("x")).collect()]
    assert got == ["    ~ [gen] done  (n=3 ok=True why=None who=x y)", "    ~ [gen] idle", "    ~ [gen] none"]


def test_chunk_labels(spark):
    rows = spark.range(1001).select(F.when(F.col("id") < 1000, "a").otherwise("b").alias("run"), F.col("id").alias("rollout_id"))
    got = run_ops.judge_chunks(rows, ["run"], F.lit("L"), bits=5).groupBy("run", "label").count().collect()
    assert {(r.run, r.label): r["count"] for r in got} == {("a", "L 1/2"): 500, ("a", "L 2/2"): 500, ("b", "L"): 1}


def test_agents_get_a_fresh_context_per_rollout(spark):
    rows = [(r, i, "user" if i % 2 == 0 else "agent", f"m{i}") for r in range(20) for i in range(6)]
    turns = spark.createDataFrame(rows, "rollout_id int, turn_idx int, role string, content string").orderBy(F.rand(1))

    def agent(transcript, context):
        context.setdefault("calls", []).append(transcript[-1]["content"])
        return ",".join(context["calls"])
    got = {(r.rollout_id, r.turn_idx): r.reply for r in judging.batch_replies(turns, agent).collect()}
    assert got == {(r, i): ",".join(f"m{j}" for j in range(0, i + 1, 2)) for r in range(20) for i in (0, 2, 4)}


def test_traces_without_failure_or_with_residual_data_make_no_scenario(spark):
    traces = spark.createDataFrame([(1, None), (2, None), (3, "complaint"), (4, "x")], "trace_id int, error string")
    turns = spark.createDataFrame([(i, 0, "user", f"help {i} a@b.co") for i in (1, 2, 3, 4)],
                                  "trace_id int, turn_idx int, role string, content string")
    events = spark.createDataFrame([(1, 0, "pay", True), (1, 1, "log", True), (2, 0, "pay", False)],
                                   "trace_id int, seq int, name string, is_error boolean")
    generated = F.when(F.col("trace_id") == 4, "call 0123456789").otherwise(F.col("goal"))
    got = {r.trace_id: (r.goal, r.failing_tool, r.category) for r in
           issues.trace_to_scenarios(traces, turns, events, generated).collect()}
    assert got == {1: ("help 1 <redacted:email>", "pay", "tool_error"), 3: ("help 3 <redacted:email>", None, "reported_error")}


def test_reports_are_written_compressed(spark, tmp_path):
    from verdictlake.sources import sinks
    sinks.write_report(spark.createDataFrame([(1, 5)], "version int, session_id int"), str(tmp_path))
    assert [f.name.endswith(".json.gz") for f in tmp_path.glob("reports/session_id=5/part*")] == [True]


def test_buckets_grow_with_rows(spark):
    from verdictlake.sources.grains import buckets_for
    assert buckets_for(spark.range(10), rows=100) == 8 and buckets_for(spark.range(900), spark.range(101), rows=100) == 11
