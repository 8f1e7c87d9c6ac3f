"""The report sink: scores and metadata only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.functions.formatting import round4, utc_millis
from verdictlake.functions.provenance import META_KEYS
from verdictlake.operators.ordered import equal_blocks, positions

PAGE = 1000

# What a report may contain. Transcripts, tool events, judge
# payloads and credentials have no place in it.
REPORT_FIELDS = {
    "totals": ["scenarios", "rollouts", "completed", "evaluated", "passed", "pass_rate"],
    "thresholds": ["pass_rate", "min_scenarios", "passed"],
    "baseline": ["quality_check_id", "branch", "pass_rate", "delta", "max_regression", "gate_passed", "effective_config"],
}
SCENARIO_FIELDS = ["scenario_id", "repeats", "passed", "pass_rate", "title", "task_family", "top_issue"]
REPORT_COLUMNS = ["version", "status", "session_id", "quality_check_id", "page", "dataset_id", "ci", "totals", "thresholds",
                  "baseline", "scenarios", "config", "report_url", "started_at", "finished_at"]


def report_rows(gated: DataFrame) -> DataFrame:
    """The nested record of every check, without its scenarios.

    ``gated`` is `gate` output with ``session_id`` and ``baseline_branch`` and, as
    far as known, ``dataset_id``, ``ci`` (a struct), ``effective_config`` and
    ``baseline_config`` (JSON texts), ``warnings``, ``report_url``, ``started_at``
    and ``finished_at``. Rates are rounded here and nowhere earlier; of ``ci`` only
    the allowlisted fields pass, and NULL fields are left out of the JSON.
    """
    def optional(name: str, kind: str) -> Column:
        return F.col(name) if name in gated.columns else F.lit(None).cast(kind)

    source: dict[tuple[str, str], Column] = {
        ("totals", "pass_rate"): round4(F.col("pass_rate")),
        ("thresholds", "pass_rate"): F.col("threshold"),
        ("thresholds", "passed"): F.col("threshold_ok"),
        ("baseline", "quality_check_id"): F.col("baseline_check_id"),
        ("baseline", "branch"): F.col("baseline_branch"),
        ("baseline", "pass_rate"): round4(F.col("baseline_rate")),
        ("baseline", "delta"): round4(F.col("delta")),
        ("baseline", "gate_passed"): F.col("regression_ok"),
        ("baseline", "effective_config"): F.try_parse_json(optional("baseline_config", "string")),
    }
    blocks = {block: F.struct(*[source.get((block, f), F.col(f)).alias(f) for f in fields])
              for block, fields in REPORT_FIELDS.items()}
    blocks["baseline"] = F.when(F.col("baseline_check_id").isNotNull(), blocks["baseline"])
    given = gated.schema["ci"].dataType.fieldNames() if "ci" in gated.columns else []
    known = [F.col(f"ci.{key}").alias(key) for key in META_KEYS if key in given]
    ci = F.struct(*known) if known else F.lit(None).cast("struct<provider:string>")
    config = F.struct(F.try_parse_json(optional("effective_config", "string")).alias("effective"),
                      F.coalesce(optional("warnings", "array<string>"), F.array().cast("array<string>")).alias("warnings"))
    times = {name: utc_millis(optional(name, "timestamp")) for name in ("started_at", "finished_at")}
    return gated.select(F.lit(1).alias("version"), "status", "session_id", F.col("check_id").alias("quality_check_id"),
                        optional("dataset_id", "string").alias("dataset_id"), ci.alias("ci"),
                        *[c.alias(n) for n, c in blocks.items()], config.alias("config"),
                        optional("report_url", "string").alias("report_url"), *[c.alias(n) for n, c in times.items()])


def scenario_pages(scorecard: DataFrame, page_size: int = PAGE) -> DataFrame:
    """(check_id, page, scenarios): scenario rows, weakest first, ``page_size`` to
    an array; places are counted block-wise, so no check is one task."""
    order = ["pass_rate", "scenario_id"]
    placed = positions(equal_blocks(scorecard, ["check_id"], order), ["check_id"], order, F.col("_block"), "place")
    shown = [round4(F.col("pass_rate")).alias(f) if f == "pass_rate" else F.col(f) for f in SCENARIO_FIELDS if f in scorecard.columns]
    return (placed.groupBy("check_id", F.floor(F.col("place") / page_size).cast("int").alias("page"))
            .agg(F.sort_array(F.collect_list(F.struct("place", F.struct(*shown).alias("row")))).alias("rows"))
            .select("check_id", "page", F.col("rows.row").alias("scenarios")))


def report_pages(report: DataFrame, pages: DataFrame) -> DataFrame:
    """Records with their scenarios. Page 0 is the whole record; a check with more
    scenarios goes on in records that hold nothing but ids, page and scenarios. A
    check without scenarios has page 0 alone."""
    of = pages.withColumnRenamed("check_id", "quality_check_id")
    none = F.array().cast(of.schema["scenarios"].dataType)
    first = report.join(of.filter("page = 0").drop("page"), "quality_check_id", "left").withColumns(
        {"page": F.lit(0), "scenarios": F.coalesce("scenarios", none)})
    more = of.filter("page > 0").join(report.select("quality_check_id", "session_id", "version"), "quality_check_id")
    return first.unionByName(more, allowMissingColumns=True).select(*[c for c in REPORT_COLUMNS if c in first.columns])


def write_report(report: DataFrame, path: str) -> None:
    """Write report records as gzipped JSON lines by session. A session that is reported again
    is replaced whole; sessions without a record in ``report`` keep theirs. Any
    column outside the allowlist is refused."""
    scenarios = report.schema["scenarios"].dataType.elementType.fieldNames() if "scenarios" in report.columns else []
    extra = (set(report.columns) - set(REPORT_COLUMNS)) | (set(scenarios) - set(SCENARIO_FIELDS))
    if extra:
        raise ValueError(f"not allowed in a report: {sorted(extra)}")
    (report.write.partitionBy("session_id").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("compression", "gzip").json(f"{path}/reports"))
