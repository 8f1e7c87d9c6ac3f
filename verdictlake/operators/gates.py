"""Baselines, gates, exit codes, reuse decisions and the text summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.functions.formatting import percent, points, round4, whole_percent
from verdictlake.operators.ordered import BLOCK_ROWS, carry_last, equal_blocks
from verdictlake.operators.scorecard import latest_check_summary, latest_per_session, rate_of


def baseline_for(runs: DataFrame, checks: DataFrame, verdicts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """As-of join: for each run the newest succeeded check of its session on its
    baseline branch, strictly earlier than the run. The newest is taken first
    and then dropped if nothing was evaluated; older ones are no substitute.

    Runs and candidates shrink to one row per (session, branch, instant): runs of
    one instant share their answer. The last candidate is carried forward over
    instants, in blocks of ``block_rows`` where a branch has more, and the runs
    look their instant up. ``verdicts(check_id, evaluated, passed)`` are attached
    to candidates first, one row per check to one row per check.
    """
    candidate = F.struct("check_id", "evaluated", "passed")
    at = ["session_id", "branch", "created_at"]
    known = (checks.filter("status = 'succeeded'").select("check_id", *at)
             .join(verdicts.select("check_id", "evaluated", "passed"), "check_id", "left")
             .select(*at, candidate.alias("candidate")))
    asked = runs.select("check_id", "session_id", F.col("baseline_branch").alias("branch"), "created_at")
    instants = (known.unionByName(asked.select(*at), allowMissingColumns=True)
                .groupBy(*at).agg(F.max_by("candidate", "candidate.check_id").alias("candidate")))
    blocked = equal_blocks(instants, at[:2], at[2:], block_rows)
    found = (carry_last(blocked, at[:2], at[2:], F.col("_block"), F.col("candidate"), "baseline")
             .filter("baseline.evaluated > 0").select(*at, "baseline"))
    return asked.join(found, at).select(
        "check_id", F.col("baseline.check_id").alias("baseline_check_id"), F.col("branch").alias("baseline_branch"),
        F.col("baseline.passed").alias("baseline_passed"), F.col("baseline.evaluated").alias("baseline_evaluated"),
        rate_of(F.col("baseline.passed"), F.col("baseline.evaluated")).alias("baseline_rate"))


def gate(totals: DataFrame, configs: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """Status of every check: enough verdicts AND threshold AND regression.

    ``configs`` has ``check_id, threshold, min_scenarios, max_regression`` (NULL:
    informational). Rates are compared unrounded. ``min_scenarios`` counts
    evaluated rollouts. Every configured check has a row: one without totals has
    counts and rate 0 and fails.
    """
    counts = [c for c in totals.columns if c != "check_id"]
    known = (configs.join(totals, "check_id", "left")
             .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(totals.schema[c].dataType)) for c in counts}))
    if baseline is None:
        joined = known.withColumns(
            {"baseline_check_id": F.lit(None).cast("bigint"), "baseline_rate": F.lit(None).cast("double")})
    else:
        joined = (known
                  .join(baseline.select("check_id", "baseline_check_id", "baseline_rate"), "check_id", "left"))
    enough = F.col("evaluated") >= F.col("min_scenarios")
    delta = F.col("pass_rate") - F.col("baseline_rate")
    held = F.coalesce(-delta <= F.col("max_regression"), F.lit(True))
    return (joined.withColumns({"enough": enough, "delta": delta, "regression_ok": held})
            .withColumn("threshold_ok", F.col("enough") & (F.col("pass_rate") >= F.col("threshold")))
            .withColumn("status", F.when(F.col("threshold_ok") & F.col("regression_ok"), "passed")
                        .otherwise("failed")))


def exit_code(status: Column, warn_only: Column, config_error: Column, infra_error: Column) -> Column:
    """0 gates met, 1 gate failed, 2 config error, 3 infrastructure error.
    Advisory mode turns only a 1 into 0."""
    return (F.when(config_error, 2).when(infra_error, 3)
            .when((status == "passed") | warn_only, 0).otherwise(1))


def reuse_decision(sessions: DataFrame, datasets: DataFrame, checks: DataFrame,
                   evaluations: DataFrame, models: DataFrame, count: int = 100,
                   lowest: float = 0.6, highest: float = 0.9) -> DataFrame:
    """Per session: reuse the latest dataset or generate a new one, and why.

    Each input shrinks to one row per session before it is joined. In order:
    forced, none yet, rate outside the closed band, other size, reuse.
    ``sessions`` may carry a boolean ``reprobe``.
    """
    forced = F.coalesce("reprobe", F.lit(False)) if "reprobe" in sessions.columns else F.lit(False)
    newest = latest_per_session(datasets, "dataset_id").select("session_id", "dataset_id", "row_count")
    judged = latest_check_summary(checks, evaluations)
    people = models.select("session_id").distinct().withColumn("has_model", F.lit(True))
    rows = (sessions.join(newest, "session_id", "left").join(judged, "session_id", "left")
            .join(people, "session_id", "left"))
    rate = F.col("success_rate")
    none = F.col("dataset_id").isNull()
    drifted = (rate < lowest) | (rate > highest)
    resized = F.col("row_count") != count
    rows = (rows.withColumn("success_rate", rate_of(F.col("passed"), F.col("total")))
            .withColumn("step", F.when(forced, "forced").when(none, "none")
                        .when(drifted, "drift").when(resized, "size").otherwise("reuse")))
    step = F.col("step")
    band = F.concat(F.lit("success rate "), whole_percent(rate))
    # Reason texts.
    reason = (F.when(step == "forced", "reprobe requested")
              .when(step == "none", "no datasets in this session yet")
              .when(step == "drift", F.concat(
                  band, F.when(rate < lowest, F.concat(F.lit(" below "), whole_percent(F.lit(lowest))))
                  .otherwise(F.concat(F.lit(" above "), whole_percent(F.lit(highest)))),
                  F.lit("; regenerating calibrated on "), F.col("check_id").cast("string")))
              .when(step == "size", F.concat(F.lit("latest dataset has "), F.col("row_count").cast("string"),
                                             F.lit(f" rows; requested {count}")))
              .when(rate.isNotNull(), F.concat(band, F.lit(" within "), whole_percent(F.lit(lowest)),
                                               F.lit("-"), whole_percent(F.lit(highest)), F.lit(" band")))
              .otherwise("no completed quality check to judge by; reusing latest dataset"))
    keep_model = step.isin("none", "size") & F.coalesce("has_model", F.lit(False))
    kept = F.when(keep_model, "; reusing session user model (no drift signal)").otherwise("")
    return rows.select(
        "session_id", F.when(step == "reuse", "reused").otherwise("generated").alias("action"),
        F.when(step == "reuse", F.col("dataset_id")).alias("dataset_id"),
        ((step != "reuse") & ~keep_model).alias("probes"),
        F.when(step == "drift", F.col("check_id")).alias("calibrating_check"),
        F.when(~step.isin("forced", "none"), rate).alias("success_rate"),
        F.concat(reason, kept).alias("reason"))


def render_summary(gated: DataFrame, weakest: DataFrame) -> DataFrame:
    """Summary text per check. ``gated`` is `gate` output with ``branch`` and
    ``report_url``; ``weakest`` at most eight rows per check with ``place``,
    ``passed, repeats, title, task_family, top_issue``."""
    # The texts of the summary lines.
    family = F.coalesce(F.concat(F.lit(" ["), "task_family", F.lit("]")), F.lit(""))
    line = F.concat(F.lit("    "), F.col("passed").cast("string"), F.lit("/"),
                    F.col("repeats").cast("string"), F.lit("  "),
                    F.coalesce(F.col("title"), F.col("scenario_id").cast("string")), family,
                    F.coalesce(F.concat(F.lit("\n         ↳ "), "top_issue"), F.lit("")))
    listed = (weakest.groupBy("check_id")
              .agg(F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("lines"))
              .select("check_id", F.concat_ws("\n", F.lit(""), F.lit("  weakest scenarios:"),
                                              F.col("lines.line")).alias("weak_text")))
    rate, base = round4(F.col("pass_rate")), round4(F.col("baseline_rate"))
    has = F.col("baseline_rate").isNotNull()
    against = F.when(has, F.concat(F.lit(" (baseline "), "branch", F.lit(": "), percent(base), F.lit(", Δ "),
                                   points(round4(F.col("delta"))), F.lit(")"))) \
        .otherwise(" (no baseline found — first run on this branch?)")
    head = F.concat(F.lit("  pass rate "), percent(rate), F.lit(" — "), F.col("passed").cast("string"),
                    F.lit("/"), F.col("evaluated").cast("string"), F.lit(" rollouts across "),
                    F.col("scenarios").cast("string"), F.lit(" scenarios"), against)
    threshold = F.concat(F.lit("  threshold "), percent(F.col("threshold")), F.lit(": "),
                         F.when(F.col("threshold_ok"), "met").otherwise("NOT MET"))
    regression = F.when(has & F.col("max_regression").isNotNull(), F.concat(
        F.lit("  regression gate (max "), percent(F.col("max_regression")), F.lit("): "),
        F.when(F.col("regression_ok"), "met").otherwise("NOT MET")))
    warned = (F.when(F.size("warnings") > 0, F.array_join(
        F.transform("warnings", lambda w: F.concat(F.lit("  warning: "), w)), "\n"))
        if "warnings" in gated.columns else F.lit(None).cast("string"))
    url = F.concat(F.lit("  full report: "), F.col("report_url"))
    return (gated.join(listed, "check_id", "left")
            .select("check_id", F.concat_ws("\n", F.lit(""), head, threshold, regression, warned,
                                            F.col("weak_text"), F.lit(""), url, F.lit("")).alias("summary")))
