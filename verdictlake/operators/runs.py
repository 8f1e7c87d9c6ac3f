"""Run lists, session roll-ups, trends and judging batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.operators.ordered import BLOCK_ROWS, carry_last, equal_blocks, number_block, positions

CHUNK = 500  # fixed value: rollouts judged together


def list_runs(runs: DataFrame, run_type: str | None = None, branch: str | None = None,
              session=None, limit: int | None = None) -> DataFrame:
    """Runs newest first. Filters reach the scan; a limit keeps only the top
    rows of every task (no global sort)."""
    for column, wanted in (("type", run_type), ("branch", branch), ("session_id", session)):
        if wanted is not None:
            runs = runs.filter(F.col(column) == wanted)
    ordered = runs.orderBy(F.desc("created_at"), F.desc("type"), F.desc("run_id"))
    return ordered if limit is None else ordered.limit(limit)


def recent_activity(requests: DataFrame, limit: int = 50) -> DataFrame:
    """The latest request rows."""
    return requests.orderBy(F.desc("created_at"), F.desc("event_id")).limit(limit)


def session_rollup(sessions: DataFrame, runs: DataFrame, rollouts: DataFrame) -> DataFrame:
    """Runs, rollouts and last activity per session, idle sessions kept. Both
    tables shrink to one row per session before they are joined."""
    ran = runs.groupBy("session_id").agg(F.count("*").alias("runs"), F.max("created_at").alias("last_activity"))
    per_check = rollouts.groupBy("check_id").agg(F.count("*").alias("n"))
    checks = runs.filter("type = 'quality_check'").select(F.col("run_id").alias("check_id"), "session_id")
    played = (per_check.join(checks, "check_id")
              .groupBy("session_id").agg(F.sum("n").alias("rollouts")))
    zero = F.lit(0).cast("bigint")
    return (sessions.join(ran, "session_id", "left").join(played, "session_id", "left")
            .select("session_id", "name", F.coalesce("runs", zero).alias("runs"),
                    F.coalesce("rollouts", zero).alias("rollouts"), "last_activity"))


def pass_rate_trend(checks: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Change of each check against the one before it on its branch. A branch of
    more than ``block_rows`` checks is cut at its quantiles."""
    branch, order = ["session_id", "branch"], ["created_at", "check_id"]
    seen = carry_last(equal_blocks(checks, branch, order, block_rows), branch, order, F.col("_block"),
                      F.col("pass_rate"), "previous_rate")
    return seen.drop("_block").withColumn("delta", F.col("pass_rate") - F.col("previous_rate"))


def judge_chunks(rollouts: DataFrame, by: Sequence[str], label: Column, size: int = CHUNK,
                 bits: int = 20) -> DataFrame:
    """Stable batches of ``size`` rollouts per run, in rollout order; the label
    gets `` i/n`` only where there is more than one batch."""
    placed = positions(rollouts, by, ["rollout_id"], number_block("rollout_id", bits), "_pos")
    counts = rollouts.groupBy(*by).agg(F.count("*").alias("_n"))
    chunk = F.floor(F.col("_pos") / size) + 1
    chunks = F.ceil(F.col("_n") / size)
    suffix = F.when(F.col("chunks") > 1, F.concat(F.lit(" "), F.col("chunk").cast("string"), F.lit("/"),
                                                  F.col("chunks").cast("string"))).otherwise("")
    return (placed.join(counts, list(by))
            .withColumns({"chunk": chunk, "chunks": chunks})
            .withColumn("label", F.concat(label, suffix)).drop("_pos", "_n"))


def state_trajectory(evaluations: DataFrame) -> DataFrame:
    """One row per transition of a rollout's ordered ``states`` array: position,
    from, to, changed. Works inside each row, without a shuffle."""
    step = F.transform(F.sequence(F.lit(2), F.size("states")), lambda i: F.struct(
        (i - 1).alias("step"), F.element_at("states", i - 1).alias("from_state"),
        F.element_at("states", i).alias("to_state")))
    return (evaluations.filter(F.size("states") > 1)
            .select("check_id", "rollout_id", "eval_seq", F.inline(step))
            .withColumn("changed", ~F.col("from_state").eqNullSafe(F.col("to_state"))))


def transition_counts(trajectory: DataFrame) -> DataFrame:
    return trajectory.groupBy("from_state", "to_state").agg(F.count("*").alias("n"))


def event_feed(events: DataFrame, cursors: DataFrame) -> DataFrame:
    """Events after each run's cursor, in order. ``cursors(run_id, after)`` may
    miss runs, which then read from the start."""
    return (events.join(cursors, "run_id", "left")
            .filter(F.col("seq") > F.coalesce("after", F.lit(0)))
            .drop("after").orderBy("run_id", "seq"))


def next_cursors(fed: DataFrame) -> DataFrame:
    return fed.groupBy("run_id").agg(F.max("seq").alias("after"))


def event_line(stage: Column, message: Column, data: Column) -> Column:
    """``[stage] message  (k=v ...)`` for an event with JSON ``data``."""
    # The texts of an event line.
    pairs = F.map_entries(F.from_json(data, "map<string,variant>"))

    def shown(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
        return F.when(kind == "BOOLEAN", F.initcap(text)).when(kind == "VOID", "None").otherwise(text)

    detail = F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), shown(p["value"]))), " ")
    tail = F.when(F.length(detail) > 0, F.concat(F.lit("  ("), detail, F.lit(")"))).otherwise("")
    return F.concat(F.lit("    ~ ["), stage, F.lit("] "), message, F.coalesce(tail, F.lit("")))

