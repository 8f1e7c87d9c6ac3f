"""Verdicts, scorecards, totals and the small set operations around them.

Grains are aggregated before they are joined (one row per rollout, per check),
so nothing fans out, and every aggregate combines on the map side first: a check
or session holding most of the data costs one small row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdictlake.functions.judge import AGENT_KEYS, agent_columns, agent_label, findings, first_finding
from verdictlake.session import written


def rate_of(passed: Column, total: Column, empty: float | None = None) -> Column:
    """passed / total as a double; ``empty`` (default NULL) when total is 0."""
    value = F.when(total > 0, passed.cast("double") / total)
    return value if empty is None else value.otherwise(empty)


def latest_verdicts(evaluations: DataFrame) -> DataFrame:
    """The last verdict of every rollout in every check, by ``eval_seq``."""
    return (evaluations.groupBy("check_id", "rollout_id")
            .agg(F.max_by("passed", "eval_seq").alias("verdict")))


def attach_verdicts(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Every rollout with its last verdict in its own check, NULL where nobody
    judged it there; a rollout listed under two checks keeps two verdicts."""
    return rollouts.join(latest_verdicts(evaluations), ["check_id", "rollout_id"], "left")


def unjudged_rollouts(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Rollouts without a verdict in their own check. Judged ids are made distinct
    first, on the map side too, so a rollout judged very often is one row in the
    join."""
    grain = ["check_id", "rollout_id"]
    return rollouts.join(evaluations.select(*grain).distinct(), grain, "left_anti")


def played_scenarios(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """The common base of scorecard and totals, one row per (check, scenario):
    rollouts, completed, judged repeats, passes."""
    return (attach_verdicts(rollouts, evaluations)
            .groupBy("check_id", "scenario_id")
            .agg(F.count("*").alias("rollouts"), F.count_if(F.col("status") == "completed").alias("completed"),
                 F.count("verdict").alias("repeats"), F.count_if("verdict").alias("passed")))


def scenario_scorecard(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Judged repeats, passes and rate per (check, scenario)."""
    return scorecard_of(played_scenarios(rollouts, evaluations))


def scorecard_of(played: DataFrame) -> DataFrame:
    return played.select("check_id", "scenario_id", "repeats", "passed",
                         rate_of(F.col("passed"), F.col("repeats"), 0.0).alias("pass_rate"))


def attach_scenario_meta(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Add title, family and top issue; blank texts become NULL. The catalog is
    joined as it is: the optimizer broadcasts it only below its size threshold."""
    known = [c for c in ("title", "task_family", "top_issue") if c in meta.columns]
    blanks = {c: F.nullif(F.col(c), F.lit("")) for c in known}
    on = [c for c in ("check_id", "scenario_id") if c in meta.columns]
    return rows.join(meta.select(*on, *known).withColumns(blanks), on, "left")


def suite_totals(rollouts: DataFrame, evaluations: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """One row per check; every verdict counts, re-judgements included. With
    ``checks`` every check has a row, at 0 where nothing was played."""
    played = rollouts.groupBy("check_id", "scenario_id").agg(
        F.count("*").alias("rollouts"), F.count_if(F.col("status") == "completed").alias("completed"))
    return totals_of(played, evaluations, checks)


def totals_of(played: DataFrame, evaluations: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """Suite totals from rows per (check, scenario), e.g. `played_scenarios`."""
    suites = played.groupBy("check_id").agg(
        F.count("*").alias("scenarios"), F.sum("rollouts").alias("rollouts"), F.sum("completed").alias("completed"))
    if checks is not None:
        suites = checks.select("check_id").distinct().join(suites, "check_id", "left")
    judged = check_verdicts(evaluations)
    zero = F.lit(0).cast("bigint")
    return (suites.join(judged, "check_id", "left")
            .withColumns({c: F.coalesce(c, zero) for c in ("scenarios", "rollouts", "completed", "evaluated", "passed")})
            .withColumn("pass_rate", rate_of(F.col("passed"), F.col("evaluated"), 0.0)))


def check_verdicts(evaluations: DataFrame) -> DataFrame:
    """Evaluated and passed per check that has any verdict."""
    return evaluations.groupBy("check_id").agg(
        F.count("*").alias("evaluated"), F.count_if("passed").alias("passed"))


def pooled_pass_rate(evaluations: DataFrame, by: list[str]) -> DataFrame:
    """Pass rate over all chunks and repeats of a group, NULL when empty."""
    return (evaluations.groupBy(*by)
            .agg(F.count("passed").alias("evaluated"), F.count_if("passed").alias("passed"))
            .withColumn("pass_rate", rate_of(F.col("passed"), F.col("evaluated"))))


def union_repeats(*runs: DataFrame) -> DataFrame:
    """Pool the results of repeats or chunks, duplicates kept."""
    pooled = runs[0]
    for run in runs[1:]:
        pooled = pooled.unionByName(run)
    return pooled


def weakest_first(scorecard: DataFrame) -> DataFrame:
    return scorecard.orderBy("pass_rate", "scenario_id")


def weakest_scenarios(scorecard: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` weakest failing scenarios per check. Spark limits each task to
    ``n`` rows per check before the shuffle (window group limit)."""
    weakest = Window.partitionBy("check_id").orderBy("pass_rate", "scenario_id")
    return (scorecard.filter("pass_rate < 1")
            .withColumn("place", F.row_number().over(weakest)).filter(F.col("place") <= n))


def fold_scenario_meta(rows: DataFrame, redact: Callable[[Column], Column] | None = None) -> DataFrame:
    """Fold evaluation rows of a scenario, in ``ord``: last non-blank title and
    family, and of the failed rows the first finding, scrubbed by ``redact`` and
    then cut to 160. A row's finding is the first issue its ``judge`` JSON lists,
    or the column ``issue`` where there is no ``judge``."""
    def last_filled(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name) != "", F.col("ord"))).alias(name)

    issue = first_finding(F.col("judge")) if "judge" in rows.columns else F.col("issue")
    found = rows.withColumn("_issue", F.when(~F.coalesce("passed", F.lit(False)), nullif_blank(issue)))
    # The winner is picked on the raw finding; only winners are scrubbed.
    folded = found.groupBy("check_id", "scenario_id").agg(
        last_filled("title"), last_filled("task_family"),
        F.min_by("_issue", F.when(F.col("_issue").isNotNull(), F.col("ord"))).alias("issue"))
    shown = redact(F.col("issue")) if redact else F.col("issue")
    return folded.withColumn("top_issue", F.substring(shown, 1, 160)).drop("issue")


def nullif_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def latest_per_session(rows: DataFrame, id_column: str) -> DataFrame:
    """The newest row of every session, by (created_at, id)."""
    place = F.struct("created_at", id_column)
    others = [c for c in rows.columns if c != "session_id"]
    return (rows.groupBy("session_id").agg(F.max_by(F.struct(*others), place).alias("row"))
            .select("session_id", "row.*"))


def latest_check_summary(checks: DataFrame, evaluations: DataFrame) -> DataFrame:
    """(id, passed, total) of each session's newest succeeded check."""
    newest = latest_per_session(checks.filter("status = 'succeeded'"), "check_id")
    counts = evaluations.groupBy("check_id").agg(
        F.count("*").alias("total"), F.count_if("passed").alias("passed"))
    zero = F.lit(0).cast("bigint")
    return (newest.join(counts, "check_id", "left")
            .select("session_id", "check_id", F.coalesce("passed", zero).alias("passed"),
                    F.coalesce("total", zero).alias("total")))


def expand_repeats(rows: DataFrame, repeats: Column) -> DataFrame:
    """Each scenario once per repeat, numbered from 1."""
    return rows.withColumn("repeat", F.explode(F.sequence(F.lit(1), repeats)))


def dataset_rows(bridge: DataFrame, scenarios: DataFrame, dataset_id=None) -> DataFrame:
    """Scenario rows of one dataset (or all), resolved by reference."""
    if dataset_id is not None:
        bridge = bridge.filter(F.col("dataset_id") == dataset_id)
    return bridge.join(scenarios, "scenario_id")


def list_datasets(datasets: DataFrame, session=None) -> DataFrame:
    """Newest first, of one session where given."""
    if session is not None:
        datasets = datasets.filter(F.col("session_id") == session)
    return datasets.orderBy(F.desc("created_at"), F.desc("dataset_id"))


def list_user_models(models: DataFrame, session=None) -> DataFrame:
    """Oldest first, of one session where given."""
    if session is not None:
        models = models.filter(F.col("session_id") == session)
    return models.orderBy("created_at", "user_model_id")


def default_dataset(sessions: DataFrame, datasets: DataFrame) -> DataFrame:
    """The dataset a session plays when it names none: its own newest, else the
    account's newest with a note, else an error."""
    own = latest_per_session(datasets, "dataset_id").select(
        "session_id", F.col("dataset_id").alias("own"))
    newest = datasets.agg(F.max_by("dataset_id", F.struct("created_at", "dataset_id"))).scalar()
    joined = sessions.join(own, "session_id", "left").withColumn("any", newest)
    # Note texts.
    note = (F.when(F.col("own").isNotNull(), F.lit(None))
            .when(F.col("any").isNotNull(), F.concat(F.lit("no dataset in this session yet; using latest dataset "),
                                                     F.col("any").cast("string")))
            .otherwise("no datasets exist yet; generate one first"))
    return joined.select("session_id", F.coalesce("own", "any").alias("dataset_id"),
                         note.alias("note"),
                         F.coalesce("own", "any").isNull().alias("is_error"))


def compose_dataset(requested: DataFrame, models: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Bridge rows for requested (model, scenario) pairs. A model's dataset is
    accepted only when every scenario belongs to its representation; offenders,
    all scenarios asked for an unknown model among them, are returned beside the
    rows, flagged."""
    asked = requested.join(models.select("user_model_id", "representation_id"), "user_model_id", "left")
    owned = scenarios.select("scenario_id", F.col("representation_id").alias("owner"))
    checked = (asked.join(owned, "scenario_id", "left")
               .withColumn("belongs", F.coalesce(F.col("owner") == F.col("representation_id"), F.lit(False))))
    verdicts = checked.groupBy("user_model_id").agg(F.bool_and("belongs").alias("accepted"))
    return (checked.join(verdicts, "user_model_id")
            .select("user_model_id", "scenario_id", "belongs", "accepted"))


DIFF_ROWS = 1_000_000


def dataset_diff(pairs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per pair (dataset_a, dataset_b): each scenario added, removed or shared.

    Memberships are narrow and compress well, so tasks sized by their bytes would
    hold very many: the memberships are written once and counted, and dealt out by
    scenario into tasks of about ``DIFF_ROWS``.
    """
    bridge = written(bridge.select("dataset_id", "scenario_id"), "diff-bridge")
    tasks = max(8, -(-2 * bridge.count() // DIFF_ROWS))

    def side(name: str, a: int, b: int) -> DataFrame:
        return (pairs.join(bridge.withColumnRenamed("dataset_id", name), name)
                .select("dataset_a", "dataset_b", "scenario_id", F.lit(a).alias("a"), F.lit(b).alias("b")))

    grain = ["dataset_a", "dataset_b", "scenario_id"]
    both = side("dataset_a", 1, 0).unionByName(side("dataset_b", 0, 1)).repartition(tasks, *grain).groupBy(*grain).agg(
        F.max("a").alias("a"), F.max("b").alias("b"))
    change = (F.when(F.col("a") + F.col("b") == 2, "shared")
              .when(F.col("a") == 1, "removed").otherwise("added"))
    return both.select("dataset_a", "dataset_b", "scenario_id", change.alias("change"))


def _judged_rates(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return (rows.groupBy(*by)
            .agg(F.count("*").alias("rollouts"), F.count("verdict").alias("judged"),
                 F.count_if("verdict").alias("passed"))
            .withColumn("pass_rate", rate_of(F.col("passed"), F.col("judged"))))


def agent_version_compare(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Rollouts, judged, passed and rate by agent version."""
    return _judged_rates(attach_verdicts(rollouts, evaluations), ["agent_version"])


def agent_compare(rollouts: DataFrame, evaluations: DataFrame) -> DataFrame:
    """The same by agent name, version and model, read from ``agent_meta`` JSON;
    agents that declare nothing are one row of NULLs."""
    named = attach_verdicts(rollouts, evaluations).withColumns(agent_columns(F.col("agent_meta")))
    return _judged_rates(named, [f"agent_{key}" for key in AGENT_KEYS])


OTHER_AGENTS = "other agents"


def agents_side_by_side(rollouts: DataFrame, evaluations: DataFrame, by: Sequence[str] = ("scenario_id",),
                        most: int = 20) -> DataFrame:
    """Pass rates per ``by``, one column per agent (``name@version (model)``).

    The ``most`` agents with most rollouts get a column each, named by what is
    found: one row per agent, at most ``most``, reaches the driver. All others
    share the column ``other agents``, so no rollout is left out. A cell is NULL
    where the agent has no verdict.
    """
    named = rollouts.withColumns(agent_columns(F.col("agent_meta"))).withColumn("agent", agent_label())
    sizes = named.groupBy("agent").agg(F.count("*").alias("n"))
    labels = [r.agent for r in sizes.orderBy(F.desc("n"), "agent").limit(most).collect()]
    shown = F.when(F.col("agent").isin(labels), F.col("agent")).otherwise(OTHER_AGENTS)
    # Verdicts are counted per (group, agent) before they are spread over columns.
    return (attach_verdicts(named.withColumn("agent", shown), evaluations)
            .groupBy(*by).pivot("agent", [*sorted(labels), OTHER_AGENTS]).agg(F.avg(F.col("verdict").cast("double"))))


def family_scorecard(rollouts: DataFrame, evaluations: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Rates by (family, scenario), by family and overall. Verdicts are first
    reduced to one row per scenario, so the rollup expands only that."""
    per_scenario = (attach_verdicts(rollouts, evaluations).groupBy("scenario_id")
                    .agg(F.count("verdict").alias("n"), F.count_if("verdict").alias("ok")))
    named = per_scenario.join(scenarios.select("scenario_id", "task_family"), "scenario_id", "left")
    return (named.rollup("task_family", "scenario_id")
            .agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("judged"), F.sum("ok").alias("passed"))
            .withColumn("pass_rate", rate_of(F.col("passed"), F.col("judged"))))


def issue_frequency(rows: DataFrame) -> DataFrame:
    """Findings counted with their affected scenarios: every text that a row's
    ``judge`` JSON lists, or its column ``issue`` where there is no ``judge``.
    Distinct counting goes through (issue, scenario) rows, so one frequent issue
    spreads over tasks."""
    issue = F.explode(findings(F.col("judge"))) if "judge" in rows.columns else F.col("issue")
    return (rows.select("scenario_id", issue.alias("issue")).filter(nullif_blank(F.col("issue")).isNotNull())
            .groupBy("issue", "scenario_id").agg(F.count("*").alias("n"))
            .groupBy("issue").agg(F.sum("n").alias("findings"), F.count("*").alias("scenarios")))
