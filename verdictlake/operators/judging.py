"""Rule-based judging and user functions run as batch jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIMS = r"(?i)\b(?:refunded|cancelled|booked|sent|updated|processed|scheduled)\b"


def judge_rollouts(rollouts: DataFrame, turns: DataFrame, events: DataFrame,
                   claims: str = CLAIMS) -> DataFrame:
    """Evaluations by four column rules (ours): an unrecovered tool error, an
    empty reply, a claimed action without any tool call, the turn cap reached.

    ``rollouts(rollout_id, turn, max_turns)``. Every rule is an aggregate with
    map-side combine; rollouts are joined with one row each.
    """
    last_calls = events.groupBy("rollout_id", "name").agg(F.max_by("is_error", "seq").alias("failed"))
    called = last_calls.groupBy("rollout_id").agg(F.bool_or("failed").alias("unrecovered"))
    agent = F.col("role") == "agent"
    said = turns.groupBy("rollout_id").agg(
        F.bool_or(agent & (F.trim("content") == "")).alias("empty_reply"),
        F.bool_or(agent & F.col("content").rlike(claims)).alias("claims"))
    no = F.lit(False)
    facts = (rollouts.join(called, "rollout_id", "left").join(said, "rollout_id", "left")
             .withColumns({"unrecovered": F.coalesce("unrecovered", no), "calls": F.col("unrecovered").isNotNull(),
                           "empty_reply": F.coalesce("empty_reply", no), "claims": F.coalesce("claims", no)}))
    issues = F.array_compact(F.array(
        F.when(F.col("unrecovered"), "tool error never recovered"),
        F.when(F.col("empty_reply"), "empty reply"),
        F.when(F.col("claims") & ~F.col("calls"), "claimed an action no tool performed"),
        F.when(F.col("turn") >= F.col("max_turns"), "turn cap reached")))
    return (facts.select("rollout_id", issues.alias("issues"))
            .select("rollout_id", (F.size("issues") == 0).alias("passed"), "issues"))


def judge_with(rollouts: DataFrame, judge: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Evaluations by a user's judge, called with batches of rollout rows. It
    returns ``rollout_id, passed, issues`` for the rows of the batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield judge(batch)
    key = rollouts.schema["rollout_id"].dataType.simpleString()
    return rollouts.mapInPandas(run, f"rollout_id {key}, passed boolean, issues array<string>")


def batch_replies(turns: DataFrame, agent: Callable[[list[dict], dict], str]) -> DataFrame:
    """Call a user's agent on every recorded prefix that ends in a user turn.

    Conversations are spread by rollout and sorted inside the tasks; rows then
    stream through the function, which holds one running transcript. Each
    rollout gets a fresh ``context``; nothing is shared between rollouts.
    """
    key = turns.schema["rollout_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, transcript, context = None, [], {}
        for batch in batches:
            replies = []
            for rollout, idx, role, content in zip(batch["rollout_id"], batch["turn_idx"],
                                                   batch["role"], batch["content"]):
                if rollout != current:
                    current, transcript, context = rollout, [], {}
                transcript.append({"role": role, "content": content})
                if role == "user":
                    replies.append((rollout, idx, agent(list(transcript), context)))
            yield pd.DataFrame(replies, columns=["rollout_id", "turn_idx", "reply"])

    spread = (turns.select("rollout_id", "turn_idx", "role", "content")
              .repartition("rollout_id").sortWithinPartitions("rollout_id", "turn_idx"))
    return spread.mapInPandas(run, f"rollout_id {key}, turn_idx int, reply string")


def probe_turns(questions: DataFrame, events: DataFrame) -> DataFrame:
    """A question as a one-turn conversation with the tool calls made for it:
    one row per call, one row with NULL call where none was made."""
    turn = F.array(F.struct(F.lit("user").alias("role"), F.col("question").alias("content")))
    calls = events.select("probe_id", "seq", "name", "input", "is_error")
    return (questions.select("probe_id", turn.alias("transcript"), "reply")
            .join(calls, "probe_id", "left"))


def reply_text(reply: Column, is_file: Column, redact: Callable[[Column], Column]) -> Column:
    """A text reply redacted; a file reply passes through untouched."""
    return F.when(is_file, reply).otherwise(redact(reply))
