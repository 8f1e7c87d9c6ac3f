"""Usage, issue, detail, validation, judging and source queries."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdictlake.operators import issues, judging, replay, runs as run_ops, scorecard, usage, validation
from verdictlake.operators.ordered import number_block, positions
from verdictlake.operators.scorecard import attach_verdicts
from verdictlake.plans import bindings as fx
from verdictlake.plans.registry import query
from verdictlake.plans.replay_queries import FAILURES_SQL, REPLAY_SQL, REPLAY_VIEWS, traces
from verdictlake.session import work_path
from verdictlake.sources import readers

NOW = datetime(2024, 1, 30)
WEEK = "created_at >= TIMESTAMP '2024-01-23' AND created_at < TIMESTAMP '2024-01-30'"
RANK = """
SELECT {k} AS k, latency_ms FROM (
  SELECT {k}, latency_ms, ROW_NUMBER() OVER (PARTITION BY {k} ORDER BY latency_ms) AS rn,
         count(*) OVER (PARTITION BY {k}) AS n FROM {t}) z WHERE rn = ceil(0.95::DOUBLE * n)"""


@query("recent_activity", """
SELECT event_id, route, api_key_id, status, latency_ms FROM fx_requests
ORDER BY created_at DESC, event_id DESC LIMIT 50""", "fx_requests")
def _(spark, sf):
    return run_ops.recent_activity(fx.requests(spark, sf), 50).drop("created_at")


@query("usage_summary", f"""
WITH r AS (SELECT *, CASE WHEN created_at >= TIMESTAMP '2024-01-23' THEN 'value' ELSE 'previous' END AS period
           FROM fx_requests WHERE created_at >= TIMESTAMP '2024-01-16' AND created_at < TIMESTAMP '2024-01-30'),
c AS (SELECT period, count(*) * 1.0::DOUBLE AS requests,
             count(*) FILTER (status >= 400) * 1.0::DOUBLE / count(*) AS error_rate FROM r GROUP BY period),
q AS ({RANK.format(k='period', t='r')}),
m AS (SELECT period, 'requests' AS metric, 'count' AS unit, requests AS v FROM c
      UNION ALL SELECT period, 'error_rate', 'percent', error_rate FROM c
      UNION ALL SELECT k, 'p95_latency_ms', 'ms', latency_ms FROM q)
SELECT metric, unit, max(v) FILTER (period = 'value') AS value, max(v) FILTER (period = 'previous') AS previous
FROM m GROUP BY metric, unit""", "fx_requests")
def _(spark, sf):
    return usage.usage_summary(fx.requests(spark, sf), "7d", NOW)


def metrics_sql(key: str) -> str:
    """All metrics of each value of ``key``: value, previous and points."""
    return f"""
WITH r AS (SELECT *, {key} AS k, floor(epoch(created_at - TIMESTAMP '2024-01-23') / 21600) AS b
           FROM fx_requests WHERE created_at >= TIMESTAMP '2024-01-16' AND created_at < TIMESTAMP '2024-01-30'),
s AS (SELECT k, CASE WHEN b >= 0 THEN 'value' ELSE 'previous' END AS part, -1 AS bucket, status, latency_ms FROM r
      UNION ALL SELECT k, 'point', CAST(b AS BIGINT), status, latency_ms FROM r WHERE b >= 0),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k, part, bucket ORDER BY latency_ms) AS rn, count(*) OVER (PARTITION BY k, part, bucket) AS n FROM s),
c AS (SELECT k, part, bucket, count(*) * 1.0::DOUBLE AS requests, count(*) FILTER (status >= 400) * 1.0::DOUBLE / count(*) AS error_rate,
             max(latency_ms) FILTER (rn = ceil(0.95::DOUBLE * n)) AS p95 FROM n GROUP BY k, part, bucket),
f AS (SELECT k, 'point' AS part, unnest(range(28)) AS bucket FROM (SELECT DISTINCT k FROM r) g),
m AS (SELECT k, 'requests' AS metric, part, bucket, requests AS v FROM c
      UNION ALL SELECT k, 'requests', part, bucket, 0 FROM f WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = f.k AND c.part = f.part AND c.bucket = f.bucket)
      UNION ALL SELECT k, 'error_rate', part, bucket, error_rate FROM c
      UNION ALL SELECT k, 'p95_latency_ms', part, bucket, p95 FROM c)
SELECT k, metric, CASE metric WHEN 'requests' THEN 'count' WHEN 'error_rate' THEN 'percent' ELSE 'ms' END AS unit, part,
       CASE WHEN bucket >= 0 THEN epoch_us(TIMESTAMP '2024-01-23' + to_hours(CAST(bucket * 6 AS INT))) END AS t, v FROM m"""


def flat_metrics(metrics: DataFrame, key: str) -> DataFrame:
    """A row per value, previous value and point."""
    whole = [F.struct(F.lit(p).alias("part"), F.lit(None).cast("bigint").alias("t"), F.col(p).alias("v")) for p in ("value", "previous")]
    points = F.transform("series", lambda p: F.struct(F.lit("point").alias("part"), F.unix_micros(p["t"].cast("timestamp")).alias("t"), p["v"].alias("v")))
    rows = F.filter(F.concat(F.array(*whole), points), lambda p: p["v"].isNotNull())
    return metrics.select(F.expr(key).alias("k"), "metric", "unit", F.inline(rows))


@query("usage_metrics", metrics_sql("'all'"), "fx_requests")
def _(spark, sf):
    return flat_metrics(usage.usage_metrics(fx.requests(spark, sf), "7d", NOW), "'all'")


@query("usage_key_metrics", metrics_sql("api_key_id"), "fx_requests")
def _(spark, sf):
    return flat_metrics(usage.usage_metrics(fx.requests(spark, sf), "7d", NOW, ["api_key_id"]), "api_key_id")


@query("usage_buckets", """
SELECT b.bucket, count(r.event_id) AS requests, count(*) FILTER (r.status >= 400) AS errors
FROM (SELECT unnest(range(28)) AS bucket) b
LEFT JOIN (SELECT * FROM fx_requests WHERE created_at >= TIMESTAMP '2024-01-23' AND created_at < TIMESTAMP '2024-01-30') r
  ON floor(epoch(r.created_at - TIMESTAMP '2024-01-23') / 21600) = b.bucket
GROUP BY b.bucket""", "fx_requests")
def _(spark, sf):
    return usage.usage_series(fx.requests(spark, sf), "7d", NOW)


@query("usage_by_key", f"""
WITH r AS (SELECT * FROM fx_requests WHERE {WEEK}),
q AS ({RANK.format(k='api_key_id', t='r')})
SELECT r.api_key_id, count(*) AS requests, count(*) FILTER (status >= 400) AS errors,
       any_value(q.latency_ms) AS p95_latency_ms, epoch_us(max(created_at)) AS last_used
FROM r LEFT JOIN q ON q.k = r.api_key_id GROUP BY r.api_key_id""", "fx_requests")
def _(spark, sf):
    rows = usage.usage_by_key(fx.requests(spark, sf), "7d", NOW)
    return rows.withColumn("last_used", F.unix_micros(F.to_utc_timestamp("last_used", "UTC")))


@query("usage_key_series", f"""
SELECT api_key_id, CAST(floor(epoch(created_at - TIMESTAMP '2024-01-23') / 21600) AS BIGINT) AS bucket, count(*) AS requests
FROM fx_requests WHERE {WEEK} GROUP BY 1, 2""", "fx_requests")
def _(spark, sf):
    return usage.usage_key_series(fx.requests(spark, sf), "7d", NOW)


@query("tier_scorecard", """
SELECT l_returnflag AS tier, count(*) AS simulations, sum(l_linenumber)::BIGINT AS goals_met, sum(7)::BIGINT AS goals_total,
       sum(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END + CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END)::BIGINT AS violations,
       sum(CAST(l_quantity AS INT))::BIGINT AS tool_calls, sum(l_linenumber) * 1.0::DOUBLE / sum(7) AS goal_rate
FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").selectExpr(
        "l_returnflag AS tier", "l_linenumber AS goals_met", "7 AS goals_total", "cast(l_quantity AS int) AS tool_calls",
        "array_compact(array(CASE WHEN l_tax > 0.05D THEN 'tax' END, CASE WHEN l_discount > 0.05D THEN 'discount' END)) AS violations")
    return usage.tier_scorecard(rows)


@query("voice_stats", """
SELECT o_orderstatus AS status, count(*) AS renders, sum(CAST(floor(o_totalprice) AS BIGINT))::BIGINT AS duration_ms,
       count(*) * 1.0::DOUBLE / (SELECT count(*) FROM orders) AS share,
       sum(o_custkey) * 60000.0::DOUBLE / sum(CAST(floor(o_totalprice) AS BIGINT)) AS wpm
FROM orders GROUP BY o_orderstatus""")
def _(spark, sf):
    return usage.voice_stats(fx.table(spark, sf, "orders").selectExpr(
        "o_orderstatus AS status", "floor(o_totalprice) AS duration_ms", "o_custkey AS words"))


@query("validation_validity", """
SELECT d.source AS dataset_id, count(l.quality) AS judged, count(*) FILTER (l.quality = 1) AS valid,
       CASE WHEN count(l.quality) > 0 THEN count(*) FILTER (l.quality = 1) * 1.0::DOUBLE / count(l.quality) END AS validity
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source""")
def _(spark, sf):
    return validation.validation_validity(verdict_rows(spark, sf))


def verdict_rows(spark: SparkSession, sf: str) -> DataFrame:
    labels = fx.table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("passed"))
    return (fx.trace_text(spark, sf).join(labels, "doc_id", "left")
            .select(F.col("source").alias("dataset_id"), F.col("doc_id").alias("scenario_id"),
                    F.col("lang").alias("task_family"), "text", "passed"))


MIX_SQL = """
p AS (SELECT dataset_id, lang, count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY dataset_id) AS p
      FROM (SELECT d.source AS dataset_id, d.lang FROM documents d JOIN labels l ON l.doc_id = d.doc_id) a GROUP BY 1, 2),
q AS (SELECT source AS dataset_id, lang, count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY source) AS q
      FROM documents GROUP BY 1, 2),
mix AS (SELECT COALESCE(p.dataset_id, q.dataset_id) AS dataset_id, COALESCE(p, 0) AS p, COALESCE(q, 0) AS q
        FROM p FULL JOIN q ON p.dataset_id = q.dataset_id AND p.lang = q.lang),
distance AS (SELECT dataset_id, sum(abs(p - q)) / 2 AS tv,
        sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
          + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js FROM mix GROUP BY dataset_id)"""


def fidelity(spark: SparkSession, sf: str) -> DataFrame:
    rows = verdict_rows(spark, sf)
    return validation.validation_fidelity(rows.filter("passed IS NOT NULL"), rows, "task_family")


@query("validation_fidelity", f"""
WITH {MIX_SQL} SELECT dataset_id, round(tv, 9) AS total_variation, round(js, 9) AS js_divergence FROM distance""")
def _(spark, sf):
    return fidelity(spark, sf).select("dataset_id", F.round("total_variation", 9).alias("total_variation"),
                                      F.round("js_divergence", 9).alias("js_divergence"))


SETS_SQL = r"""
texts AS (SELECT source AS dataset_id, lang, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM documents),
sets AS (SELECT *, list_sort(list_distinct(string_split(norm, ' '))) AS bag FROM texts),
mixed AS (SELECT dataset_id, -sum(p * log2(p)) AS entropy FROM (
            SELECT dataset_id, count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY dataset_id) AS p
            FROM sets GROUP BY dataset_id, lang) z GROUP BY dataset_id),
classes AS (SELECT dataset_id, sha256(array_to_string(bag, ' ')) AS set_id, any_value(bag) AS bag FROM sets GROUP BY dataset_id, sha256(array_to_string(bag, ' '))),"""

# Signatures: the least MD5 of each of 64 bins (a hex digit and a quarter of the
# next one); bands of the four bins that share the digit.
BANDS_SQL = r"""
marks AS (SELECT dataset_id, set_id, md5(w) AS m FROM (SELECT dataset_id, set_id, unnest(bag) AS w FROM classes) u),
mins AS (SELECT dataset_id, set_id, substr(m, 1, 1) AS band, min(m) AS m FROM marks
         GROUP BY dataset_id, set_id, substr(m, 1, 1), translate(substr(m, 2, 1), '0123456789abcdef', '0000111122223333')),
bands AS (SELECT dataset_id, set_id, band, string_agg(m, '' ORDER BY m) AS value FROM mins GROUP BY dataset_id, set_id, band),
firsts AS (SELECT dataset_id, band, value, min(set_id) AS earlier FROM bands GROUP BY dataset_id, band, value),
met AS (SELECT DISTINCT b.dataset_id, b.set_id, f.earlier FROM bands b JOIN firsts f
        ON f.dataset_id = b.dataset_id AND f.band = b.band AND f.value = b.value WHERE f.earlier < b.set_id),
alike AS (SELECT m.dataset_id, m.set_id, len(list_intersect(a.bag, b.bag)) AS n, len(a.bag) + len(b.bag) AS both_sizes
          FROM met m JOIN classes a ON a.dataset_id = m.dataset_id AND a.set_id = m.set_id
          JOIN classes b ON b.dataset_id = m.dataset_id AND b.set_id = m.earlier),"""

# All pairs of a dataset that share a word.
PAIRS_SQL = """
held AS (SELECT dataset_id, set_id, len(bag) AS size, unnest(bag) AS w FROM classes),
alike AS (SELECT a.dataset_id, a.set_id, b.set_id AS earlier, count(*) AS n, any_value(a.size) + any_value(b.size) AS both_sizes
          FROM held a JOIN held b ON b.dataset_id = a.dataset_id AND b.w = a.w AND b.set_id < a.set_id GROUP BY a.dataset_id, a.set_id, b.set_id),"""

LINKS_SQL = r"""
linked AS (SELECT dataset_id, count(DISTINCT set_id) AS linked_sets FROM alike WHERE n * 1.0::DOUBLE / (both_sizes - n) >= 0.8::DOUBLE GROUP BY dataset_id),
diverse AS (SELECT s.dataset_id, count(*) AS scenarios, count(DISTINCT norm) * 1.0::DOUBLE / count(*) AS distinct_share,
                   any_value(m.entropy) AS entropy,
                   (count(*) - count(DISTINCT bag) + COALESCE(any_value(l.linked_sets), 0)) * 1.0::DOUBLE / count(*) AS near
            FROM sets s JOIN mixed m ON m.dataset_id = s.dataset_id LEFT JOIN linked l ON l.dataset_id = s.dataset_id GROUP BY s.dataset_id)"""

DIVERSITY_SQL = SETS_SQL + PAIRS_SQL + LINKS_SQL


@query("validation_diversity", f"""
WITH {DIVERSITY_SQL} SELECT dataset_id, scenarios, distinct_share, round(entropy, 9) AS family_entropy,
  near AS near_duplicate_share FROM diverse""")
def _(spark, sf):
    return (validation.validation_diversity(verdict_rows(spark, sf))
            .withColumn("family_entropy", F.round("family_entropy", 9)))


@query("validation_verdict", f"""
WITH {MIX_SQL}, {SETS_SQL}{BANDS_SQL}{LINKS_SQL},
valid AS (SELECT d.source AS dataset_id, CASE WHEN count(l.quality) > 0 THEN
            count(*) FILTER (l.quality = 1) * 1.0::DOUBLE / count(l.quality) END AS validity
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source)
SELECT v.dataset_id, CASE WHEN v.validity >= 0.7::DOUBLE AND t.tv <= 0.25::DOUBLE AND d.distinct_share >= 0.8::DOUBLE
                          THEN 'pass' ELSE 'warn' END AS verdict
FROM valid v LEFT JOIN distance t ON t.dataset_id = v.dataset_id LEFT JOIN diverse d ON d.dataset_id = v.dataset_id""")
def _(spark, sf):
    rows = verdict_rows(spark, sf)
    report = (validation.validation_validity(rows).join(fidelity(spark, sf), "dataset_id", "left")
              .join(validation.validation_diversity(rows), "dataset_id", "left"))
    return validation.validation_verdict(report, min_validity=0.7).select("dataset_id", "verdict")


@query("mark_duplicate_scenarios", r"""
WITH t AS (SELECT doc_id, source, trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM documents)
SELECT doc_id AS scenario_id, source AS representation_id,
       ROW_NUMBER() OVER (PARTITION BY source, norm ORDER BY doc_id) > 1 AS is_duplicate FROM t""")
def _(spark, sf):
    rows = fx.trace_text(spark, sf).select(F.col("doc_id").alias("scenario_id"),
                                           F.col("source").alias("representation_id"), "text")
    return validation.mark_duplicate_scenarios(rows).drop("text")


WEIGHTS_SQL = """
judged AS (SELECT s.task_family, count(l.passed) AS judged, count(*) FILTER (l.passed) AS passed
           FROM fx_rollouts r LEFT JOIN fx_latest l ON l.rollout_id = r.rollout_id
           JOIN fx_scenarios s ON s.scenario_id = r.scenario_id GROUP BY s.task_family),
weights AS (SELECT *, w / sum(w) OVER () AS weight FROM (
  SELECT *, ((passed + 1.0::DOUBLE) / (judged + 2)) * (1 - (passed + 1.0::DOUBLE) / (judged + 2)) AS w FROM judged) j)"""


def weights(spark: SparkSession, sf: str) -> DataFrame:
    per_scenario = attach_verdicts(fx.rollouts(spark, sf), fx.evaluations(spark, sf)).select("scenario_id", "verdict")
    rows = per_scenario.join(fx.scenarios(spark, sf).select("scenario_id", "task_family"), "scenario_id")
    return validation.calibration_weights(rows.withColumn("scope", F.lit("account")))


@query("calibration_weights", f"""
WITH {WEIGHTS_SQL} SELECT task_family, judged, passed, round(weight, 9) AS weight FROM weights""",
       "fx_rollouts fx_latest fx_scenarios")
def _(spark, sf):
    return weights(spark, sf).select("task_family", "judged", "passed", F.round("weight", 9).alias("weight"))


@query("sample_scenarios", f"""
WITH {WEIGHTS_SQL},
sizes AS (SELECT s.task_family, count(*) AS size, any_value(w.weight) AS weight FROM fx_scenarios s
          JOIN weights w ON w.task_family = s.task_family GROUP BY s.task_family),
parts AS (SELECT *, 40 * weight / sum(weight) OVER () AS exact FROM sizes),
ranked AS (SELECT *, floor(exact) AS base, ROW_NUMBER() OVER (ORDER BY exact - floor(exact) DESC, task_family) AS rn,
                  40 - sum(floor(exact)) OVER () AS left_over FROM parts),
quota AS (SELECT task_family, base + CASE WHEN rn <= left_over THEN 1 ELSE 0 END AS quota FROM ranked),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY task_family
             ORDER BY substr(sha256('7:' || CAST(scenario_id AS VARCHAR)), 1, 10), scenario_id) AS rn FROM fx_scenarios)
SELECT p.scenario_id, p.task_family FROM placed p JOIN quota q ON q.task_family = p.task_family WHERE p.rn <= q.quota""",
       "fx_rollouts fx_latest fx_scenarios")
def _(spark, sf):
    pool = fx.scenarios(spark, sf).select("scenario_id", "task_family")
    return (validation.sample_scenarios(pool, weights(spark, sf).select("task_family", "weight"), 40, seed=7)
            .select("scenario_id", "task_family"))


def simple_rollouts(spark: SparkSession, sf: str) -> DataFrame:
    return (fx.turns(spark, sf).groupBy("rollout_id").agg(F.count("*").cast("int").alias("turn"))
            .withColumn("max_turns", F.lit(6)))


@query("judge_rollouts", r"""
WITH r AS (SELECT rollout_id, count(*) AS n FROM fx_turns GROUP BY rollout_id),
c AS (SELECT rollout_id, bool_or(failed) AS unrecovered FROM (
        SELECT rollout_id, name, arg_max(is_error, seq) AS failed
        FROM (SELECT rollout_id, seq, is_error, json_extract_string(input, '$.k') AS name FROM fx_tool_events) e
        GROUP BY rollout_id, name) z GROUP BY rollout_id),
s AS (SELECT rollout_id, bool_or(role = 'agent' AND trim(content) = '') AS empty_reply,
             bool_or(role = 'agent' AND regexp_matches(content, '(?i)\b(?:than|der|les)\b')) AS claims
      FROM fx_turns GROUP BY rollout_id),
f AS (SELECT r.rollout_id, concat_ws('|', CASE WHEN c.unrecovered THEN 'tool error never recovered' END,
             CASE WHEN s.empty_reply THEN 'empty reply' END,
             CASE WHEN s.claims AND c.rollout_id IS NULL THEN 'claimed an action no tool performed' END,
             CASE WHEN r.n >= 6 THEN 'turn cap reached' END) AS issues
      FROM r LEFT JOIN c ON c.rollout_id = r.rollout_id LEFT JOIN s ON s.rollout_id = r.rollout_id)
SELECT rollout_id, issues = '' AS passed, issues FROM f""", "fx_turns fx_tool_events")
def _(spark, sf):
    events = fx.tool_events(spark, sf).withColumn("name", F.get_json_object("input", "$.k"))
    judged = judging.judge_rollouts(simple_rollouts(spark, sf), fx.turns(spark, sf), events, claims=r"(?i)\b(?:than|der|les)\b")
    return judged.withColumn("issues", F.array_join("issues", "|"))


@query("judge_with", """
SELECT rollout_id, count(*) < 6 AS passed, CASE WHEN count(*) < 6 THEN 0 ELSE 1 END AS findings
FROM fx_turns GROUP BY rollout_id""", "fx_turns")
def _(spark, sf):
    def long_ones_fail(batch: pd.DataFrame) -> pd.DataFrame:
        passed = batch["turn"] < batch["max_turns"]
        return pd.DataFrame({"rollout_id": batch["rollout_id"], "passed": passed,
                             "issues": [[] if ok else ["too long"] for ok in passed]})
    judged = judging.judge_with(simple_rollouts(spark, sf), long_ones_fail)
    return judged.select("rollout_id", "passed", F.size("issues").alias("findings"))


@query("batch_replies", """
SELECT t.rollout_id, t.turn_idx, CAST(t.turn_idx + 1 AS VARCHAR) || ':' ||
       CAST(count(*) FILTER (u.role = 'user') AS VARCHAR) || ':' || CAST(sum(length(u.content)) AS VARCHAR) AS reply
FROM fx_turns t JOIN fx_turns u ON u.rollout_id = t.rollout_id AND u.turn_idx <= t.turn_idx
WHERE t.role = 'user' GROUP BY t.rollout_id, t.turn_idx""", "fx_turns")
def _(spark, sf):
    def agent(transcript: list[dict], context: dict) -> str:
        context["asked"] = context.get("asked", 0) + 1
        return f"{len(transcript)}:{context['asked']}:{sum(len(t['content']) for t in transcript)}"
    return judging.batch_replies(fx.turns(spark, sf), agent)


@query("probe_turns", """
SELECT o.o_orderkey AS probe_id, 1 AS turns, 'why ' || o.o_orderpriority AS question, l.l_linenumber AS call,
       l.l_returnflag AS name FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def _(spark, sf):
    asked = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS probe_id", "concat('why ', o_orderpriority) AS question", "o_orderstatus AS reply")
    calls = fx.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS probe_id", "l_linenumber AS seq", "l_returnflag AS name", "'{}' AS input", "false AS is_error")
    return judging.probe_turns(asked, calls).select(
        "probe_id", F.size("transcript").alias("turns"), F.col("transcript")[0]["content"].alias("question"),
        F.col("seq").alias("call"), "name")


def nested_documents(spark: SparkSession, sf: str, part: int = 1000) -> DataFrame:
    """Conversations in document form, as a producer would write them, in parts
    of at most ``part`` turns or events."""
    turn = F.struct("turn_idx", "role", "content")
    said = (fx.turns(spark, sf).withColumn("part", F.floor(F.col("turn_idx") / part))
            .groupBy("rollout_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("transcript")))
    call = F.struct("seq", "name", "input", "is_error", "external")
    called = (fx.tool_events(spark, sf).withColumn("part", F.floor(F.col("seq") / part))
              .groupBy("rollout_id", "part").agg(F.sort_array(F.collect_list(call)).alias("tool_events")))
    return said.join(called, ["rollout_id", "part"], "full").select(
        F.col("rollout_id").cast("string").alias("rollout_id"), (F.col("part") * part).cast("int").alias("first_turn"),
        F.transform("transcript", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("transcript"),
        "tool_events", F.lit("kept out").alias("unknown_field"))


@query("read_transcripts", """
SELECT CAST(rollout_id AS VARCHAR) AS rollout_id, turn_idx, role, content, role IN ('user', 'agent') AS role_ok FROM fx_turns""", "fx_turns")
def _(spark, sf):
    """Nested documents written as JSON to the shared folder and read back."""
    path = work_path(spark, "transcripts")
    nested_documents(spark, sf).write.json(path)
    return readers.read_transcripts(spark, path).drop("audio_url")


@query("read_tool_events", """
SELECT CAST(rollout_id AS VARCHAR) AS rollout_id, seq, name, input, is_error, external FROM fx_tool_events""",
       "fx_tool_events")
def _(spark, sf):
    path = work_path(spark, "tool-events")
    nested_documents(spark, sf).write.parquet(path)
    return readers.read_tool_events(spark, path, "parquet").drop("turn_idx", "output")


@query("project_known", """
SELECT CAST(o_orderkey AS VARCHAR) AS check_id, o_orderstatus AS status FROM orders""")
def _(spark, sf):
    from pyspark.sql.types import StringType, StructField, StructType
    known = StructType([StructField("check_id", StringType()), StructField("label", StringType()),
                        StructField("status", StringType())])
    rows = fx.table(spark, sf, "orders").selectExpr("cast(o_orderkey AS string) AS check_id", "o_custkey AS newer_field",
                                                    "o_orderstatus AS status")
    return readers.project_known(rows, known)


# A newer producer: one more field, totals as texts, statuses as texts where the
# schema wants numbers.
@query("project_rescued", """
SELECT CAST(o_orderkey AS VARCHAR) AS check_id, CAST(o_custkey AS BIGINT) AS total, TRY_CAST(code AS INT) AS status,
       '{"newer_field":' || CAST(o_custkey % 3 AS VARCHAR) || CASE WHEN TRY_CAST(code AS INT) IS NULL THEN ',"status":"' || code || '"' ELSE '' END || '}' AS rescued
FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE o_orderstatus END AS code FROM orders) o""")
def _(spark, sf):
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType
    known = StructType([StructField("check_id", StringType()), StructField("total", LongType()), StructField("status", IntegerType())])
    rows = fx.table(spark, sf, "orders").selectExpr("o_orderkey AS check_id", "cast(o_custkey AS string) AS total", "o_custkey % 3 AS newer_field",
                                                    "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE o_orderstatus END AS status")
    return readers.project_known(rows, known, "rescued")


@query("read_rescued", """
SELECT CAST(run_id AS VARCHAR) AS run_id, CASE WHEN seq % 9 <> 4 THEN seq END AS seq, stage,
       CASE WHEN seq % 9 = 4 AND seq % 7 = 3 THEN '{"seq":"x' || CAST(seq AS VARCHAR) || '","newer":{"a":[1,2.5]}}'
            WHEN seq % 9 = 4 THEN '{"seq":"x' || CAST(seq AS VARCHAR) || '"}'
            WHEN seq % 7 = 3 THEN '{"newer":{"a":[1,2.5]}}' END AS rescued
FROM fx_run_events WHERE seq % 11 <> 5
UNION ALL SELECT NULL, NULL, NULL, '{"_line":"no json ' || CAST(seq AS VARCHAR) || '"}' FROM fx_run_events WHERE seq % 11 = 5""", "fx_run_events")
def _(spark, sf):
    """Events as lines: some with a new field, some with a bad number, some broken."""
    seq = F.col("seq").cast("string")
    number = F.when(F.col("seq") % 9 == 4, F.concat(F.lit('"x'), seq, F.lit('"'))).otherwise(seq)
    line = F.concat(F.lit('{"run_id": "'), F.col("run_id").cast("string"), F.lit('", "seq": '), number, F.lit(', "stage": "'), F.col("stage"), F.lit('"'),
                    F.when(F.col("seq") % 7 == 3, F.lit(', "newer": {"a": [1, 2.5]}')).otherwise(""), F.lit("}"))
    path = work_path(spark, "event-lines")
    fx.run_events(spark, sf).select(F.when(F.col("seq") % 11 == 5, F.concat(F.lit("no json "), seq)).otherwise(line).alias("value")).write.text(path)
    return readers.read_rescued(spark, "run_events", path, "rescued").select("run_id", "seq", "stage", "rescued")


def contract_table(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written as gzipped JSON lines, as a client sends them, and read back
    with the contract's schema."""
    path = work_path(spark, f"contract-{name}")
    rows.write.option("compression", "gzip").json(path)
    return readers.read_table(spark, name, path, "json")


def as_text(*names: str) -> list:
    return [F.col(n).cast("string").alias(n) for n in names]


@query("contract_scorecard", """
SELECT CAST(check_id AS VARCHAR) AS check_id, CAST(scenario_id AS VARCHAR) AS scenario_id, repeats, passed, pass_rate FROM fx_scorecard""", "fx_scorecard")
def _(spark, sf):
    played = contract_table(spark, fx.declared(spark, sf).select(*as_text("rollout_id", "check_id", "scenario_id"), "status", "agent_meta"), "rollouts")
    judged = contract_table(spark, fx.judged(spark, sf).select(*as_text("check_id", "rollout_id"), "eval_seq", "passed", "judge"), "evaluations")
    return scorecard.scenario_scorecard(played, judged)


@query("contract_replay", REPLAY_SQL + "SELECT CAST(rollout_id AS VARCHAR) AS rollout_id, seq, version, is_fault, result_id, error FROM replayed", REPLAY_VIEWS)
def _(spark, sf):
    events = fx.tool_events(spark, sf)
    calls = contract_table(spark, events.select(*as_text("rollout_id"), "seq", "turn_idx", "name", "input", "is_error", "external"), "tool_events")
    boxes = contract_table(spark, fx.sandboxes(events).select(*as_text("rollout_id"), "turn_idx", "seed", "fail_tools", "state"), "sandboxes")
    return replay.tool_replay(calls, boxes).select("rollout_id", "seq", "version", "is_fault", "result_id", "error")


@query("contract_usage", metrics_sql("api_key_id"), "fx_requests")
def _(spark, sf):
    sent = contract_table(spark, fx.requests(spark, sf).withColumn("created_at", F.col("created_at").cast("timestamp")), "requests")
    return flat_metrics(usage.usage_metrics(sent, "7d", NOW, ["api_key_id"]), "api_key_id")


@query("turn_chat_roles", """
SELECT rollout_id, 0 AS page, string_agg(CASE role WHEN 'agent' THEN 'assistant' ELSE role END || ': ' || content,
       chr(10) ORDER BY turn_idx) AS chat FROM fx_turns GROUP BY rollout_id""", "fx_turns")
def _(spark, sf):
    chats = readers.chat_messages(fx.turns(spark, sf))
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return chats.select("rollout_id", "page", F.array_join(line, "\n").alias("chat"))


SEED_NAME = ("concat(source, '/', lang, CASE WHEN doc_id % 3 = 0 THEN '.PDF' WHEN doc_id % 3 = 1 THEN '.txt' "
             "ELSE '.tar.docx' END)")


@query("ingest_seeds", f"""
SELECT doc_id AS seed_id, CASE WHEN regexp_matches({SEED_NAME}, '(?i)\\.(pdf|docx)$') THEN 'file' ELSE 'json' END AS carrier,
       CAST(greatest(1, ceil(length(text) / 1000.0)) AS BIGINT) AS chunks FROM documents""")
def _(spark, sf):
    return readers.ingest_seeds(fx.table(spark, sf, "documents").selectExpr("doc_id AS seed_id", f"{SEED_NAME} AS filename", "text"))


@query("seed_chunks", """
SELECT d.doc_id AS seed_id, CAST(i AS INT) AS chunk, substr(d.text, CAST(i * 1000 + 1 AS BIGINT), 1000) AS content
FROM documents d, LATERAL (SELECT unnest(range(CAST(greatest(1, ceil(length(d.text) / 1000.0)) AS BIGINT))) AS i) k""")
def _(spark, sf):
    return readers.seed_chunks(fx.table(spark, sf, "documents").selectExpr("doc_id AS seed_id", "text"))


@query("event_feed", """
SELECT e.run_id, e.seq, e.stage, e.message FROM fx_run_events e
WHERE e.seq > CASE WHEN e.run_id % 2 = 0 THEN e.run_id % 40 ELSE 0 END""", "fx_run_events")
def _(spark, sf):
    cursors = fx.table(spark, sf, "events").selectExpr("user_id AS rollout_id").distinct().filter("rollout_id % 2 = 0").selectExpr("rollout_id AS run_id", "rollout_id % 40 AS after")
    return run_ops.event_feed(fx.run_events(spark, sf), cursors).select("run_id", "seq", "stage", "message")


@query("next_cursors", "SELECT run_id, max(seq) AS after FROM fx_run_events GROUP BY run_id", "fx_run_events")
def _(spark, sf):
    return run_ops.next_cursors(fx.run_events(spark, sf))


REPR_SQL = """
representations AS (
  SELECT d.doc_id AS representation_id, TIMESTAMP '2024-01-01' + to_days(CAST(d.doc_id % 300 AS INT)) AS created_at, d.source,
         CASE WHEN l.quality = 0 THEN 'low quality ' || d.lang END AS summary
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
newest AS (SELECT o_custkey AS issue_id, arg_max(o_orderkey, epoch(o_orderdate) * 10000000 + o_orderkey) AS generation_id
           FROM orders GROUP BY o_custkey)"""


def issue_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    labels = fx.table(spark, sf, "labels").select("doc_id", "quality")
    notes = F.when(F.col("quality") == 0, F.to_json(F.struct(
        F.concat(F.lit("low quality "), "lang").alias("failure_summary"), F.lit("quality").alias("failure_category"),
        F.array("lang", "source").alias("tools_involved"))))
    representations = (fx.trace_text(spark, sf).join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("representation_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(doc_id % 300 AS int))").alias("created_at"),
        "source", notes.alias("notes")))
    generations = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS generation_id", "o_custkey AS representation_id", "o_orderstatus AS status", "o_orderdate AS created_at")
    datasets = (fx.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("generation_id"))
                .agg(F.count("*").alias("row_count"))
                .select("generation_id", F.concat(F.lit("ds_"), "generation_id").alias("dataset_id"), "row_count"))
    return representations, generations, datasets


@query("list_issues", f"""
WITH {REPR_SQL}
SELECT r.representation_id AS issue_id, r.source, r.summary AS failure_summary, 'quality' AS failure_category,
       2 AS tools, n.generation_id, o.o_orderstatus AS status, d.dataset_id, d.rows
FROM representations r LEFT JOIN newest n ON n.issue_id = r.representation_id
LEFT JOIN orders o ON o.o_orderkey = n.generation_id
LEFT JOIN (SELECT l_orderkey AS g, 'ds_' || CAST(l_orderkey AS VARCHAR) AS dataset_id, count(*) AS rows
           FROM lineitem GROUP BY l_orderkey) d ON d.g = n.generation_id
WHERE r.summary IS NOT NULL""")
def _(spark, sf):
    listed = issues.list_issues(*issue_tables(spark, sf))
    return listed.select("issue_id", "source", "failure_summary", "failure_category",
                         F.size("tools_involved").alias("tools"), "generation_id", "status", "dataset_id", "rows")


def shown(pages: DataFrame) -> DataFrame:
    return pages.select("id", "section", "page", F.size("items").alias("n"), F.array_join("items", "\n").alias("items"))


PAGES_SQL = """
SELECT id, section, ord // 1000 AS page, CAST(count(*) AS INT) AS n, string_agg(item, chr(10) ORDER BY ord, item) AS items
FROM parts GROUP BY id, section, ord // 1000"""


@query("run_detail", f"""
WITH parts AS (
  SELECT check_id AS id, 'header' AS section, 0::BIGINT AS ord,
         to_json({{type: 'quality_check', status: status, session_id: session_id}})::VARCHAR AS item FROM fx_quality_checks
  UNION ALL SELECT check_id, 'evaluations', row_number() OVER (PARTITION BY check_id ORDER BY rollout_id, eval_seq) - 1, to_json({{rollout_id: rollout_id, passed: passed}})::VARCHAR
  FROM fx_evaluations
  UNION ALL SELECT run_id, 'events', seq, to_json({{seq: seq, stage: stage, message: message}})::VARCHAR FROM fx_run_events)
{PAGES_SQL}""", "fx_quality_checks fx_evaluations fx_run_events")
def _(spark, sf):
    header = fx.quality_checks(spark, sf).selectExpr("check_id AS run_id", "'quality_check' AS type", "status", "session_id")
    judged = positions(fx.evaluations(spark, sf).selectExpr("check_id AS run_id", "rollout_id", "eval_seq", "passed"),
                       ["run_id"], ["rollout_id", "eval_seq"], number_block("rollout_id"), "ord")
    return shown(issues.run_detail(header, judged, fx.run_events(spark, sf)))


@query("rollout_detail", f"""
WITH heads AS (SELECT rollout_id, rollout_id % 50 AS scenario_id, 'completed' AS status FROM fx_turns GROUP BY rollout_id),
parts AS (
  SELECT rollout_id AS id, 'scenario' AS section, 0::BIGINT AS ord,
         to_json({{scenario_id: scenario_id, status: status}})::VARCHAR AS item FROM heads
  UNION ALL SELECT rollout_id, 'turns', turn_idx, to_json({{role: role, content: content}})::VARCHAR FROM fx_turns
  UNION ALL SELECT rollout_id, 'tool_events', seq, to_json({{name: name, input: input, is_error: is_error}})::VARCHAR FROM fx_tool_events
  UNION ALL SELECT rollout_id, 'evaluations', eval_seq, to_json({{check_id: check_id, passed: passed}})::VARCHAR FROM fx_evaluations)
{PAGES_SQL}""", "fx_turns fx_tool_events fx_evaluations")
def _(spark, sf):
    heads = fx.turns(spark, sf).select("rollout_id").distinct().selectExpr(
        "rollout_id", "rollout_id % 50 AS scenario_id", "'completed' AS status")
    judged = fx.evaluations(spark, sf, dense=True).withColumnRenamed("eval_seq", "ord")
    return shown(issues.rollout_detail(heads, fx.turns(spark, sf), fx.tool_events(spark, sf), judged))


@query("issue_detail", f"""
WITH failed AS ({FAILURES_SQL}),
parts AS (
  SELECT trace_id AS id, 'failure' AS section, 0::BIGINT AS ord,
         to_json({{failure_summary: CASE WHEN trace_id % 10 = 0 THEN 'user complained' ELSE failing_tool END,
                   failure_category: category}})::VARCHAR AS item FROM failed
  UNION ALL SELECT rollout_id, 'transcript', turn_idx, to_json({{role: role, content: {fx.pii_sql('content')}}})::VARCHAR FROM fx_turns
  UNION ALL SELECT rollout_id, 'tool_events', seq, to_json({{name: name, input: input, is_error: is_error}})::VARCHAR FROM fx_tool_events
  UNION ALL SELECT scenario_id % 100, 'scenarios', scenario_id, to_json({{scenario_id: scenario_id, title: title}})::VARCHAR
  FROM fx_scenarios)
{PAGES_SQL}""", "fx_tool_events fx_turns fx_scenarios")
def _(spark, sf):
    headers, turns, events = traces(spark, sf)
    failed = (issues.trace_failures(headers, events)
              .selectExpr("trace_id AS issue_id", "coalesce(error, failing_tool) AS failure_summary", "category AS failure_category"))
    made = fx.scenarios(spark, sf).selectExpr("scenario_id % 100 AS issue_id", "scenario_id", "title", "scenario_id AS ord")
    return shown(issues.issue_detail(failed, turns.withColumnRenamed("trace_id", "issue_id"),
                                     events.withColumnRenamed("trace_id", "issue_id"), made))


@query("context_report", """
SELECT 'seeds' AS block, lang AS key, count(*) AS value FROM documents GROUP BY lang
UNION ALL SELECT 'user_models', CAST(session_id AS VARCHAR), count(*) FROM fx_user_models GROUP BY session_id
UNION ALL SELECT 'representations', representation_id, count(*) FROM fx_scenarios GROUP BY representation_id
UNION ALL SELECT 'tests', task_family, count(*) FROM fx_scenarios GROUP BY task_family
UNION ALL SELECT 'probing', role, count(*) FROM fx_turns GROUP BY role
UNION ALL SELECT 'assessment', CASE WHEN passed THEN 'passed' ELSE 'failed' END, count(*) FROM fx_evaluations GROUP BY 2""",
       "fx_user_models fx_scenarios fx_turns fx_evaluations")
def _(spark, sf):
    verdict = F.when(F.col("passed"), "passed").otherwise("failed")
    return issues.context_report({
        "seeds": fx.table(spark, sf, "documents").select(F.col("lang").alias("kind")),
        "user_models": fx.user_models(spark, sf).select(F.col("session_id").alias("kind")),
        "representations": fx.scenarios(spark, sf).select(F.col("representation_id").alias("kind")),
        "tests": fx.scenarios(spark, sf).select(F.col("task_family").alias("kind")),
        "probing": fx.turns(spark, sf).select(F.col("role").alias("kind")),
        "assessment": fx.evaluations(spark, sf).select(verdict.alias("kind"))})
