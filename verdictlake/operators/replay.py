"""Deterministic tool replay: planted faults, state versions, expected outputs.

Tables: ``events(rollout_id, seq, name, input[, turn_idx, external, is_error])``
and ``sandboxes(rollout_id, seed, fail_tools, version | state[, turn_idx])``.
``state`` is a JSON object that holds ``version`` among other keys.

A sandbox row is what its rollout runs on from turn ``turn_idx`` on: state and
planted faults are set anew there, whatever happened before. The calls from one
sandbox row to the next are a *segment*. A planted fault fails the segment's first
call to its tool; the failed call consumes the fault but leaves the state version
alone. A reported (external) call leaves the version alone too, and consumes the
fault only if it reports a failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.functions.canonical import call_hash
from verdictlake.operators.ordered import BLOCK_ROWS, carry_last, equal_blocks, number_block, prefix_sums


def _external(events: DataFrame) -> Column:
    return F.coalesce("external", F.lit(False)) if "external" in events.columns else F.lit(False)


def _turn(rows: DataFrame) -> Column:
    return F.coalesce("turn_idx", F.lit(0)) if "turn_idx" in rows.columns else F.lit(0)


def _version(sandboxes: DataFrame) -> Column:
    if "state" in sandboxes.columns:
        return F.coalesce(F.get_json_object("state", "$.version").cast("bigint"), F.lit(0))
    return F.coalesce("version", F.lit(0)).cast("bigint")


def sandbox_plans(sandboxes: DataFrame) -> DataFrame:
    """(rollout_id, plans): a rollout's sandbox rows in order of turn, at most one
    per turn of a conversation, which the contract limits to 40."""
    return (sandboxes.select("rollout_id", F.struct(_turn(sandboxes).alias("segment"), "seed", "fail_tools",
                                                    _version(sandboxes).alias("start")).alias("plan"))
            .groupBy("rollout_id").agg(F.sort_array(F.collect_list("plan")).alias("plans")))


def _in_segments(events: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """Events with ``plan``, the sandbox row their turn runs on: the last one up
    to it (NULL before the first). Each rollout brings one row to the join, so a
    rollout with very many calls is split by AQE."""
    reached = F.filter("plans", lambda p: p["segment"] <= _turn(events))
    return (events.join(sandbox_plans(sandboxes), "rollout_id", "left")
            .withColumn("plan", F.get(reached, F.size(reached) - 1)).drop("plans"))


def on_sandboxes(events: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """Events with what their turn runs on: ``segment``, ``seed``, ``planted`` and
    ``start`` (the version), as `stream_replay_check` wants them."""
    none = F.array().cast("array<string>")
    return _in_segments(events, sandboxes).select(
        *events.columns, F.coalesce("plan.segment", F.lit(-1)).alias("segment"), F.coalesce("plan.seed", F.lit(0)).alias("seed"),
        F.coalesce("plan.fail_tools", none).alias("planted"), F.coalesce("plan.start", F.lit(0)).alias("start"))


SEGMENT = ["rollout_id", "segment"]


def _faults(planned: DataFrame) -> DataFrame:
    """(rollout_id, segment, faults): the calls that hit a planted fault, of each
    tool planted to fail the segment's first call that is synthetic or a failed
    report. Firsts are a partial aggregate, one row per (segment, tool); the list
    is never longer than the sandbox row's own ``fail_tools``."""
    able = ~_external(planned) | (F.coalesce("is_error", F.lit(False)) if "is_error" in planned.columns else F.lit(True))
    first = F.min(F.struct("seq", _external(planned).alias("external"))).alias("first")
    return (planned.filter(able & F.array_contains("plan.fail_tools", F.col("name")))
            .groupBy("rollout_id", F.col("plan.segment").alias("segment"), "name").agg(first)
            .groupBy(*SEGMENT).agg(F.collect_list("first").alias("faults")))


def _is_fault() -> Column:
    return F.coalesce(F.exists("faults", lambda f: f["seq"] == F.col("seq")), F.lit(False))


def first_call_fault(events: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """Add ``is_fault``: the call hits a planted fault."""
    planned = _in_segments(events, sandboxes)
    return (planned.withColumn("segment", F.col("plan.segment")).join(_faults(planned), SEGMENT, "left")
            .withColumn("is_fault", _is_fault()).select(*events.columns, "is_fault"))


def state_version(events: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """Add ``is_fault``, ``seed``, ``segment`` and the state ``version`` each call
    saw: what its sandbox row starts with, plus the segment's earlier synthetic
    calls, less those that were faults. Sums restart with each segment and run
    over blocks of calls, so that no rollout is one task."""
    planned = _in_segments(events, sandboxes)
    marked = planned.select(*events.columns, F.coalesce("plan.segment", F.lit(-1)).alias("segment"),
                            F.coalesce("plan.seed", F.lit(0)).alias("seed"), F.coalesce("plan.start", F.lit(0)).alias("start"))
    counted = prefix_sums(marked, SEGMENT, ["seq"], number_block("seq"), earlier=(~_external(events)).cast("bigint"))
    failed = F.size(F.filter("faults", lambda f: (f["seq"] < F.col("seq")) & ~f["external"]))
    version = F.col("start") + F.col("earlier") - F.when(F.col("faults").isNull(), 0).otherwise(failed)
    return (counted.join(_faults(planned), SEGMENT, "left")
            .withColumns({"is_fault": _is_fault(), "version": version})
            .select(*events.columns, "is_fault", "seed", "segment", "version"))


def tool_replay(events: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """Add the expected output of each call: ``result_id`` or ``error``; both
    NULL for external calls, whose output only the agent knows."""
    seen = state_version(events, sandboxes)
    synthetic = ~_external(events)
    digest = call_hash(F.col("name"), F.col("input"), F.col("version"), F.col("seed"))
    return seen.withColumns({
        "result_id": F.when(synthetic & ~F.col("is_fault"), digest),
        "error": F.when(synthetic & F.col("is_fault"), F.concat("name", F.lit(" is unavailable"))),
    })


def final_sandbox_state(replayed: DataFrame, sandboxes: DataFrame) -> DataFrame:
    """State map after the last call, one (rollout, key, value) row per entry:
    the entries of the rollout's last sandbox row, ``version`` moved on by the
    segment's successes and ``last_<tool>`` of every tool that succeeded in it.
    Values are texts; JSON values other than texts are written as JSON.

    A success per (segment, tool) and each entry of a sandbox row meet in one
    aggregate per (rollout, key): later segments win, within one the calls do.
    """
    kept = "state" in sandboxes.columns
    entries = F.map_entries(F.coalesce(F.from_json("state", "map<string,variant>"), F.create_map().cast("map<string,variant>"))) if kept else F.array()
    text = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), F.coalesce(
        F.try_variant_get(e["value"], "$", "string"), F.to_json(e["value"])).alias("value"))) if kept else F.array().cast("array<struct<key:string,value:string>>")
    own = F.concat(F.filter(text, lambda e: e["key"] != "version"),
                   F.array(F.struct(F.lit("version").alias("key"), _version(sandboxes).cast("string").alias("value"))))
    start = (sandboxes.select("rollout_id", _turn(sandboxes).alias("segment"), F.explode(own).alias("e"))
             .select("rollout_id", "segment", F.lit(0).alias("step"), "e.key", "e.value", F.lit(0).cast("bigint").alias("n")))
    good = (replayed.filter("result_id IS NOT NULL").groupBy(*SEGMENT, "name")
            .agg(F.max_by("result_id", "seq").alias("value"), F.count("*").alias("n")))
    moved = F.array(F.struct(F.concat(F.lit("last_"), "name").alias("key"), F.col("value").alias("value"), F.lit(0).cast("bigint").alias("n")),
                    F.struct(F.lit("version").alias("key"), F.lit(None).cast("string").alias("value"), F.col("n").alias("n")))
    calls = good.select(*SEGMENT, F.lit(1).alias("step"), F.inline(moved))
    # Per key what each segment leaves; then only the rollout's last segment counts.
    place = F.struct("segment", "step")
    by_segment = (start.unionByName(calls.select(*start.columns))
                  .groupBy("rollout_id", "key", "segment").agg(F.max_by("value", F.when(F.col("value").isNotNull(), place)).alias("value"), F.sum("n").alias("n")))
    last = sandboxes.groupBy("rollout_id").agg(F.max(_turn(sandboxes)).alias("segment"))
    moved_on = (F.col("value").cast("bigint") + F.col("n")).cast("string")
    return (by_segment.join(last, SEGMENT)
            .select("rollout_id", "key", F.when(F.col("key") == "version", moved_on).otherwise(F.col("value")).alias("value")))


def replay_mismatches(reported: DataFrame, expected: DataFrame) -> DataFrame:
    """Synthetic calls whose reported ``result_id`` or ``error`` differs, or which
    the replay does not know (both wanted columns NULL)."""
    want = expected.select("rollout_id", "seq", F.col("result_id").alias("want_id"),
                           F.col("error").alias("want_error"), F.lit(True).alias("known"))
    return (reported.filter(~_external(reported)).join(want, ["rollout_id", "seq"], "left")
            .filter("known IS NULL OR NOT (result_id <=> want_id AND error <=> want_error)")
            .select("rollout_id", "seq", "name", "result_id", "want_id", "error", "want_error"))


def assign_turn_idx(turns: DataFrame, events: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give each event the latest turn recorded before it, at least 0.

    Both tables carry ``rollout_id`` and ``at``; events also ``seq``. A turn and
    an event of the same instant count as turn first. A rollout of more than
    ``block_rows`` rows is cut at its quantiles, however close in time they lie.
    """
    first_event = 1 << 62  # turns of an instant are numbered below its events
    marks = turns.select("rollout_id", "at", F.col("turn_idx").cast("bigint").alias("place"))
    calls = events.select("rollout_id", "at", (F.lit(first_event) + F.col("seq").cast("bigint")).alias("place"))
    rows, order = marks.unionByName(calls), ["at", "place"]
    seen = prefix_sums(equal_blocks(rows, ["rollout_id"], order, block_rows), ["rollout_id"], order,
                       F.col("_block"), turns_before=(F.col("place") < first_event).cast("bigint"))
    return (seen.filter(F.col("place") >= first_event)
            .select("rollout_id", (F.col("place") - first_event).alias("seq"),
                    F.greatest(F.lit(0), F.col("turns_before") - 1).cast("int").alias("turn_idx")))


def tool_call_stats(events: DataFrame, by: Sequence[str] = ("name",)) -> DataFrame:
    """Calls, errors and recoveries by tool. An error is recovered when the next
    call of the same tool in the rollout succeeds."""
    steps = carry_last(events, ["rollout_id", "name"], ["seq"], number_block("seq"),
                       F.col("is_error"), "was_error")
    return (steps.groupBy(*by)
            .agg(F.count("*").alias("calls"), F.count_if("is_error").alias("errors"),
                 F.count_if(F.col("was_error") & ~F.col("is_error")).alias("recovered"))
            .withColumn("error_share", F.col("errors").cast("double") / F.col("calls")))
