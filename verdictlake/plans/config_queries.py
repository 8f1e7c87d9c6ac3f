"""Configuration, policy, provenance and format queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdictlake.functions import formatting as fmt, provenance as pv
from verdictlake.operators import config
from verdictlake.plans import bindings as fx
from verdictlake.plans.registry import query

# One order = one config, good and bad ones; valid in both engines.
RAW_CONFIG = """
concat('{"version": ', CASE WHEN o_orderkey % 19 = 0 THEN '2' ELSE '1' END,
       CASE WHEN o_orderkey % 23 = 0 THEN ', "tresholds": {}' ELSE '' END,
       ', "agent": {"entrypoint": "', CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE 'agent.py' END, '"}',
       ', "run": {"dataset": "', CASE WHEN o_orderkey % 7 = 0 THEN 'set-' ELSE 'ds_' END, CAST(o_custkey AS VARCHAR(20)),
       '", "max_turns": ', CAST(o_custkey % 45 AS VARCHAR(20)),
       ', "repeats": ', CASE WHEN o_orderkey % 11 = 0 THEN '1.5' ELSE CAST(o_custkey % 7 AS VARCHAR(20)) END,
       CASE WHEN o_orderkey % 13 = 0 THEN ', "max_turn": 3' ELSE '' END,
       '}, "thresholds": {"pass_rate": ', CASE WHEN o_orderkey % 17 = 0 THEN '"high"' ELSE '0.8' END,
       '}, "telemetry": {"redact": {"enabled": ', CASE WHEN o_orderkey % 31 = 0 THEN '1' ELSE 'true' END, '}}}')
"""


@query("config_violations", f"""
WITH c AS (SELECT o_orderkey AS run_id, o_custkey AS k, {RAW_CONFIG} AS raw FROM orders)
SELECT run_id, 'version' AS path, 'must be 1' AS issue FROM c WHERE json_extract_string(raw, '$.version') <> '1'
UNION ALL SELECT run_id, 'tresholds',
  'unknown key (allowed: version, agent, run, thresholds, baseline, telemetry, output)'
  FROM c WHERE json_extract(raw, '$.tresholds') IS NOT NULL
UNION ALL SELECT run_id, 'agent.entrypoint', 'expected a non-empty string'
  FROM c WHERE trim(json_extract_string(raw, '$.agent.entrypoint')) = ''
UNION ALL SELECT run_id, 'run.dataset', 'expected a ds_… dataset id'
  FROM c WHERE NOT regexp_matches(json_extract_string(raw, '$.run.dataset'), '^ds_[a-z0-9]+$')
UNION ALL SELECT run_id, 'run.max_turns', CASE WHEN k % 45 < 2 THEN 'must be >= 2' ELSE 'must be <= 40' END
  FROM c WHERE k % 45 < 2 OR k % 45 > 40
UNION ALL SELECT run_id, 'run.repeats', CASE WHEN run_id % 11 = 0 THEN 'expected an integer'
    WHEN k % 7 < 1 THEN 'must be >= 1' ELSE 'must be <= 5' END
  FROM c WHERE run_id % 11 = 0 OR k % 7 < 1 OR k % 7 > 5
UNION ALL SELECT run_id, 'run.max_turn',
  'unknown key (allowed: dataset, max_turns, concurrency, repeats, timeout_minutes)'
  FROM c WHERE json_extract(raw, '$.run.max_turn') IS NOT NULL
UNION ALL SELECT run_id, 'thresholds.pass_rate', 'expected a number'
  FROM c WHERE json_type(raw, '$.thresholds.pass_rate') = 'VARCHAR'
UNION ALL SELECT run_id, 'telemetry.redact.enabled', 'expected true or false'
  FROM c WHERE json_type(raw, '$.telemetry.redact.enabled') <> 'BOOLEAN'""")
def _(spark, sf):
    rows = fx.table(spark, sf, "orders").selectExpr("o_orderkey AS run_id", f"{RAW_CONFIG} AS raw_config")
    return config.config_violations(rows)


FILES_SQL = """
SELECT o_orderkey AS run_id, o_custkey % 20 AS session_id,
       CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey % 40 AS INT) END AS file_max_turns,
       CASE WHEN o_orderkey % 4 = 0 THEN 9 END AS flag_max_turns,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 12 AS INT) END AS file_concurrency,
       CASE WHEN o_orderkey % 6 = 0 THEN 2 END AS flag_repeats,
       CASE WHEN o_custkey % 4 = 0 THEN 3 END AS file_repeats,
       CASE WHEN o_custkey % 3 = 1 THEN NULL ELSE 0.5 + (o_custkey % 4) * 0.125 END AS file_pass_rate,
       CASE WHEN o_custkey % 6 = 0 THEN 'develop' END AS file_baseline_branch,
       CASE WHEN o_custkey % 2 = 0 THEN 0.1 END AS file_max_regression,
       CASE WHEN o_custkey % 8 = 0 THEN 5 END AS file_min_scenarios,
       'ds_' || CAST(o_custkey AS VARCHAR(20)) AS file_dataset
FROM orders"""

MERGED_SQL = f"""
merged AS (
  SELECT run_id, session_id, COALESCE(flag_max_turns, file_max_turns, 12) AS max_turns,
         COALESCE(file_concurrency, 4) AS concurrency, COALESCE(flag_repeats, file_repeats, 1) AS repeats,
         CAST(file_pass_rate AS DOUBLE) AS pass_rate, COALESCE(file_baseline_branch, 'main') AS baseline_branch,
         CAST(file_max_regression AS DOUBLE) AS max_regression, COALESCE(file_min_scenarios, 1) AS min_scenarios,
         file_dataset AS dataset
  FROM ({FILES_SQL}) f)"""


def merged(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.sql(FILES_SQL.replace("FROM orders", "FROM {orders}"), orders=fx.table(spark, sf, "orders"))
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("file_pass_rate", "file_max_regression")})
    return config.merge_config(rows)


@query("merge_config", f"WITH {MERGED_SQL} SELECT * FROM merged")
def _(spark, sf):
    return merged(spark, sf)


@query("effective_config", f"""
WITH {MERGED_SQL}
SELECT run_id, to_json({{run: {{dataset: dataset, max_turns: max_turns, concurrency: concurrency, repeats: repeats}},
  thresholds: {{pass_rate: pass_rate, min_scenarios: min_scenarios}},
  baseline: {{branch: baseline_branch, max_regression: max_regression}}}})::VARCHAR AS effective_config
FROM merged""")
def _(spark, sf):
    return config.effective_config(merged(spark, sf)).select("run_id", "effective_config")


@query("config_drift", f"""
WITH {MERGED_SQL},
paths AS (
  SELECT run_id, unnest(['run.dataset', 'run.max_turns', 'run.concurrency', 'run.repeats', 'thresholds.pass_rate',
                         'thresholds.min_scenarios', 'baseline.branch', 'baseline.max_regression']) AS path,
         unnest(['"' || dataset || '"', CAST(max_turns AS VARCHAR), CAST(concurrency AS VARCHAR),
                 CAST(repeats AS VARCHAR), COALESCE(CAST(pass_rate AS VARCHAR), 'null'),
                 CAST(min_scenarios AS VARCHAR), '"' || baseline_branch || '"',
                 COALESCE(CAST(max_regression AS VARCHAR), 'null')]) AS v FROM merged)
SELECT a.run_id, a.path, b.v AS base_value, a.v AS run_value, 'changed' AS change
FROM paths a JOIN paths b ON b.run_id = a.run_id - 1 AND b.path = a.path WHERE a.v <> b.v
UNION ALL SELECT run_id, path, NULL, v, 'added' FROM paths WHERE run_id = 0
UNION ALL SELECT run_id + 1, path, v, NULL, 'removed' FROM paths
  WHERE run_id = (SELECT max(run_id) FROM paths)""")
def _(spark, sf):
    """Each run against the one before it."""
    runs = config.effective_config(merged(spark, sf)).select("run_id", "effective_config")
    return config.config_drift(runs, runs.withColumn("run_id", F.col("run_id") + 1))


@query("apply_policy", f"""
WITH {MERGED_SQL},
p AS (SELECT session_id + 5 AS session_id, CASE WHEN session_id % 3 = 0 THEN 0.75::DOUBLE END AS lowest,
             CASE WHEN session_id % 2 = 0 THEN 6 END AS cap,
             CASE WHEN session_id % 4 <> 1 THEN 0.7::DOUBLE END AS fallback
      FROM fx_sessions),
j AS (SELECT m.*, p.lowest, p.cap, p.fallback, COALESCE(m.pass_rate, p.fallback) AS stated
      FROM merged m LEFT JOIN p ON p.session_id = m.session_id)
SELECT run_id, CASE WHEN stated IS NOT NULL THEN greatest(stated, lowest) END AS pass_rate,
       least(concurrency, cap) AS concurrency,
       CASE WHEN stated IS NOT NULL THEN concat_ws('|',
         CASE WHEN pass_rate IS NULL THEN 'thresholds.pass_rate not set — using your organization''s default (' || CAST(fallback AS VARCHAR) || ')' END,
         CASE WHEN stated < lowest THEN 'thresholds.pass_rate ' || CAST(stated AS VARCHAR) || ' is below your organization''s floor — raised to ' || CAST(lowest AS VARCHAR) END,
         CASE WHEN concurrency > cap THEN 'run.concurrency ' || CAST(concurrency AS VARCHAR) || ' exceeds your organization''s cap — lowered to ' || CAST(cap AS VARCHAR) END) END AS warnings,
       CASE WHEN stated IS NULL THEN 'thresholds.pass_rate: required (0..1)' END AS config_error
FROM j""", "fx_sessions")
def _(spark, sf):
    policy = fx.sessions(spark, sf).selectExpr(
        "session_id + 5 AS session_id", "CASE WHEN session_id % 3 = 0 THEN 0.75D END AS pass_rate_floor",
        "CASE WHEN session_id % 2 = 0 THEN 6 END AS max_concurrency",
        "CASE WHEN session_id % 4 <> 1 THEN 0.7D END AS default_pass_rate")
    applied = config.apply_policy(merged(spark, sf), policy)
    return applied.select("run_id", "pass_rate", "concurrency", F.array_join("warnings", "|").alias("warnings"), "config_error")


CI_SQL = """
SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'feature-' || CAST(o_custkey AS VARCHAR(20))
            WHEN o_orderkey % 3 = 1 THEN '' END AS head_ref,
       CASE WHEN o_orderkey % 5 = 0 THEN 'main' WHEN o_orderkey % 5 = 1 THEN 'x/merge'
            ELSE CAST(o_custkey AS VARCHAR(20)) || '/merge' END AS ref_name,
       CASE WHEN o_orderkey % 7 = 0 THEN 'https://git.example.org' END AS server,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'acme/bot-' || CAST(o_custkey % 9 AS VARCHAR(20)) END AS repo,
       CAST(o_orderkey AS VARCHAR(20)) AS ci_run_id,
       CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE lower(o_orderpriority) || 'abcdef' END AS sha,
       CASE WHEN o_orderkey % 4 = 0 THEN 'suite' END AS suffix
FROM orders"""


def ci_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(CI_SQL.replace("FROM orders", "FROM {orders}"), orders=fx.table(spark, sf, "orders"))


@query("ci_provenance", f"""
WITH c AS (SELECT *, COALESCE(NULLIF(head_ref, ''), ref_name) AS branch FROM ({CI_SQL}) r)
SELECT run_id, branch,
       CASE WHEN NULLIF(head_ref, '') IS NOT NULL AND ref_name LIKE '%/merge'
            THEN TRY_CAST(split_part(ref_name, '/', 1) AS INT) END AS pr,
       CASE WHEN repo IS NOT NULL THEN COALESCE(server, 'https://github.com') || '/' || repo ||
            '/actions/runs/' || ci_run_id END AS run_url
FROM c""")
def _(spark, sf):
    return pv.ci_provenance(ci_rows(spark, sf)).select("run_id", "branch", "pr", "run_url")


@query("session_and_label", f"""
SELECT run_id, 'ci/' || COALESCE(repo, 'work') || COALESCE('/' || suffix, '') AS session,
       'ci ' || COALESCE(NULLIF(head_ref, ''), '?') || '@' || substr(COALESCE(NULLIF(sha, ''), 'local'), 1, 7) AS label
FROM ({CI_SQL}) r""")
def _(spark, sf):
    return ci_rows(spark, sf).select(
        "run_id", pv.session_name(F.col("repo"), F.lit("work"), F.col("suffix")).alias("session"),
        pv.run_label(F.col("head_ref"), F.col("sha")).alias("label"))


@query("repo_slug", """
SELECT page_id, NULLIF(regexp_extract(url, '[/:]([^/:]+/[^/]+?)(?:\\.git)?$', 1), '') AS page_slug,
       NULLIF(regexp_extract(replace(replace(url, 'https://', 'git@'), '/', ':') || '/bot.git',
              '[/:]([^/:]+/[^/]+?)(?:\\.git)?$', 1), '') AS ssh_slug FROM pages""")
def _(spark, sf):
    ssh = F.concat(F.replace(F.replace("url", F.lit("https://"), F.lit("git@")), F.lit("/"), F.lit(":")), F.lit("/bot.git"))
    return fx.table(spark, sf, "pages").select("page_id", pv.repo_slug(F.col("url")).alias("page_slug"),
                                               pv.repo_slug(ssh).alias("ssh_slug"))


@query("compact_metadata", f"""
SELECT run_id, concat_ws(',', 'branch=' || NULLIF(head_ref, ''), 'commit_sha=' || NULLIF(sha, ''), 'repo=' || repo,
       'run_id=' || ci_run_id) AS meta,
       CASE WHEN repo IS NOT NULL THEN to_json({{repo: repo, branch: head_ref, commit_sha: sha}})::VARCHAR END AS ci_block
FROM ({CI_SQL}) r""")
def _(spark, sf):
    rows = ci_rows(spark, sf)
    meta = F.create_map(*[x for k, c in (("branch", "head_ref"), ("commit_sha", "sha"), ("repo", "repo"),
                                         ("run_id", "ci_run_id"), ("token", "ci_run_id")) for x in (F.lit(k), F.col(c))])
    kept = F.sort_array(F.map_entries(pv.compact_metadata(meta)))
    shown = F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    block = pv.agent_metadata(F.create_map(F.lit("name"), F.lit('"bot"')), F.col("repo"), F.col("head_ref"), F.col("sha"))
    return rows.select("run_id", shown.alias("meta"), F.try_element_at(block, F.lit("ci")).alias("ci_block"))


@query("format_rate", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, x, round_even(x * 10000, 0) / 10000 AS rounded,
       printf('%.1f%%', x * 100) AS percent, CAST(CAST(round_even(x * 100, 0) AS BIGINT) AS VARCHAR) || '%' AS whole,
       CASE WHEN d >= 0 THEN '+' ELSE '' END || printf('%.1fpp', d * 100) AS points,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.') || '000Z' AS shown
FROM (SELECT *, l_linenumber / l_quantity AS x, l_tax - l_discount AS d FROM lineitem) v""")
def _(spark, sf):
    rows = fx.table(spark, sf, "lineitem").selectExpr("*", "l_linenumber / l_quantity AS x", "l_tax - l_discount AS d")
    x = F.col("x")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "x",
                       fmt.round4(x).alias("rounded"), fmt.percent(x).alias("percent"),
                       fmt.whole_percent(x).alias("whole"), fmt.points(F.col("d")).alias("points"),
                       fmt.utc_millis(F.col("l_shipdate")).alias("shown"))
