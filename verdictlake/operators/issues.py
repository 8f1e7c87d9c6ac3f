"""Production traces, issues and detail records.

Detail records come in bounded pieces: one row per (id, section, page) with an
ordered array of at most ``page_size`` items. A record of usual size is one page
per section; an outsized one continues on further pages instead of growing into
one task. Sections are unioned, so children never multiply each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.functions.redaction import has_pii, redact_pii, redact_pii_json, redact_secrets, \
    redact_secrets_json, text_hook

PAGE_SIZE = 1000


def section(rows: DataFrame, name: str, key: str, order: str | None, *columns: str) -> DataFrame:
    """Rows of one child table as (id, section, ord, item JSON)."""
    place = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")
    return rows.select(F.col(key).alias("id"), F.lit(name).alias("section"), place.alias("ord"),
                       F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("item"))


def paged_record(*sections: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Sections as ordered item arrays, page by page."""
    rows = sections[0]
    for other in sections[1:]:
        rows = rows.unionByName(other)
    return (rows.withColumn("page", F.floor(F.col("ord") / page_size))
            .groupBy("id", "section", "page")
            .agg(F.sort_array(F.collect_list(F.struct("ord", "item"))).alias("items"))
            .select("id", "section", "page", F.col("items.item").alias("items")))


def _only(df: DataFrame, key: str, wanted) -> DataFrame:
    return df if wanted is None else df.filter(F.col(key) == wanted)


def run_detail(runs: DataFrame, evaluations: DataFrame, events: DataFrame, run_id=None) -> DataFrame:
    """Header, evaluations and ordered events of one run, or of all."""
    return paged_record(
        section(_only(runs, "run_id", run_id), "header", "run_id", None, "type", "status", "session_id"),
        section(_only(evaluations, "run_id", run_id), "evaluations", "run_id", "ord", "rollout_id", "passed"),
        section(_only(events, "run_id", run_id), "events", "run_id", "seq", "seq", "stage", "message"))


def rollout_detail(rollouts: DataFrame, turns: DataFrame, events: DataFrame, evaluations: DataFrame,
                   rollout_id=None) -> DataFrame:
    """Scenario, turns, tool events and evaluations of one rollout, or of all."""
    return paged_record(
        section(_only(rollouts, "rollout_id", rollout_id), "scenario", "rollout_id", None, "scenario_id", "status"),
        section(_only(turns, "rollout_id", rollout_id), "turns", "rollout_id", "turn_idx", "role", "content"),
        section(_only(events, "rollout_id", rollout_id), "tool_events", "rollout_id", "seq", "name", "input", "is_error"),
        section(_only(evaluations, "rollout_id", rollout_id), "evaluations", "rollout_id", "ord", "check_id", "passed"))


def list_issues(representations: DataFrame, generations: DataFrame, datasets: DataFrame,
                limit: int | None = None) -> DataFrame:
    """Trace-born representations, newest first, with what they produced. Only
    those with notes are issues; the filter runs before either join."""
    notes = F.from_json("notes", "failure_summary string, failure_category string, tools_involved array<string>")
    issues = (representations.filter("notes IS NOT NULL").withColumn("n", notes)
              .select(F.col("representation_id").alias("issue_id"), "created_at", "source",
                      "n.failure_summary", "n.failure_category", "n.tools_involved"))
    newest = (generations.groupBy(F.col("representation_id").alias("issue_id"))
              .agg(F.max_by(F.struct("generation_id", "status"), F.struct("created_at", "generation_id")).alias("g"))
              .select("issue_id", "g.generation_id", "g.status"))
    made = datasets.select("generation_id", "dataset_id", F.col("row_count").alias("rows"))
    ordered = (issues.join(newest, "issue_id", "left").join(made, "generation_id", "left")
               .orderBy(F.desc("created_at"), F.desc("issue_id")))
    return ordered if limit is None else ordered.limit(limit)


def issue_detail(issues: DataFrame, turns: DataFrame, events: DataFrame, scenarios: DataFrame,
                 issue_id=None, hook: Callable[[str], str] | None = None) -> DataFrame:
    """The distilled failure, the redacted conversation and its scenarios."""
    clean_turns, clean_events = redact_trace(_only(turns, "issue_id", issue_id),
                                             _only(events, "issue_id", issue_id), hook)
    return paged_record(
        section(_only(issues, "issue_id", issue_id), "failure", "issue_id", None, "failure_summary", "failure_category"),
        section(clean_turns, "transcript", "issue_id", "turn_idx", "role", "content"),
        section(clean_events, "tool_events", "issue_id", "seq", "name", "input", "is_error"),
        section(_only(scenarios, "issue_id", issue_id), "scenarios", "issue_id", "ord", "scenario_id", "title"))


def redact_trace(turns: DataFrame, events: DataFrame,
                 hook: Callable[[str], str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Personal data out of turn contents and event payloads; NULL output stays.
    ``hook`` sees every text after the built-in detectors, those inside payloads
    too. A payload that is no JSON becomes NULL."""
    def clean(df: DataFrame) -> DataFrame:
        payloads = [c for c in ("input", "output") if c in df.columns]
        done = redact_pii_json(*[F.col(c) for c in payloads], hook=hook)
        return df.withColumns(dict(zip(payloads, done if isinstance(done, list) else [done])))
    return turns.withColumn("content", redact_pii(F.col("content"), text_hook(hook) if hook else None)), clean(events)


def redact_replies(turns: DataFrame, events: DataFrame, extra=(), vendor=None) -> tuple[DataFrame, DataFrame]:
    """Secrets out of agent replies and event payloads. A reply that is a file
    (``reply_is_file``) passes through and keeps its flag."""
    is_text = F.col("role") == "agent"
    if "reply_is_file" in turns.columns:
        is_text = is_text & ~F.coalesce("reply_is_file", F.lit(False))
    payloads = [c for c in ("input", "output") if c in events.columns]
    done = redact_secrets_json(*[F.col(c) for c in payloads], extra=extra, vendor=vendor)
    return (turns.withColumn("content", F.when(is_text, redact_secrets(F.col("content"), extra, vendor))
                             .otherwise(F.col("content"))),
            events.withColumns(dict(zip(payloads, done if isinstance(done, list) else [done]))))


def trace_failures(traces: DataFrame, events: DataFrame) -> DataFrame:
    """Traces that show a failure: an errored event, or an error note. Adds the
    first failing tool and a category (the predicate is ours)."""
    firsts = (events.filter("is_error").groupBy("trace_id")
              .agg(F.min_by("name", "seq").alias("failing_tool")))
    failed = traces.join(firsts, "trace_id", "left")
    return (failed.filter("failing_tool IS NOT NULL OR trim(coalesce(error, '')) <> ''")
            .withColumn("category", F.when(F.col("failing_tool").isNotNull(), "tool_error").otherwise("reported_error")))


def refuse_residual_pii(texts: DataFrame, column: str = "text") -> DataFrame:
    """Scan redacted or generated text again: ``clean`` or ``quarantined``."""
    return texts.withColumn("verdict", F.when(F.coalesce(has_pii(F.col(column)), F.lit(False)), "quarantined")
                            .otherwise("clean"))


def trace_to_scenarios(traces: DataFrame, turns: DataFrame, events: DataFrame,
                       generate: Column | None = None, hook: Callable[[str], str] | None = None) -> DataFrame:
    """One reproduction candidate per failing trace: goal (first user turn,
    redacted, NULL without one), failing tool, category. ``hook`` sees the goal
    after the built-in detectors. Candidates whose goal still holds
    personal data are dropped, never repaired. ``generate`` may turn the goal
    into a text; its output is scanned too."""
    goals = (turns.filter("role = 'user'").groupBy("trace_id")
             .agg(F.min_by("content", "turn_idx").alias("goal")))
    found = (trace_failures(traces, events).join(goals, "trace_id", "left")
             .withColumn("goal", redact_pii(F.col("goal"), text_hook(hook) if hook else None)))
    found = refuse_residual_pii(found.withColumn("text", generate if generate is not None else F.col("goal")))
    return found.filter("verdict = 'clean'").select("trace_id", "goal", "failing_tool", "category", "text")


def context_report(blocks: dict[str, DataFrame]) -> DataFrame:
    """Account context as (block, key, value): counts per kind of each block.
    ``blocks`` maps a block to rows with a ``kind`` column."""
    report = None
    for name, rows in blocks.items():
        counted = (rows.groupBy(F.col("kind").cast("string").alias("key"))
                   .agg(F.count("*").alias("value"))
                   .select(F.lit(name).alias("block"), "key", "value"))
        report = counted if report is None else report.unionByName(counted)
    return report
