"""CI provenance as column expressions: branch, pull request, session, label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Provenance keys that may leave the pipeline.
META_KEYS = ["provider", "repo", "branch", "commit_sha", "run_id", "run_url", "pr"]
DEFAULT_SERVER = "https://github.com"


def filled(text: Column) -> Column:
    """NULL for empty text."""
    return F.nullif(text, F.lit(""))


def ci_provenance(runs: DataFrame) -> DataFrame:
    """Add ``branch``, ``pr`` and ``run_url`` to rows of raw CI variables
    (``head_ref``, ``ref_name``, ``server``, ``repo``, ``ci_run_id``)."""
    head, ref = filled(F.col("head_ref")), filled(F.col("ref_name"))
    number = F.when(head.isNotNull() & ref.endswith("/merge"),
                    F.split_part(ref, F.lit("/"), F.lit(1)))
    url = F.concat_ws("/", F.coalesce("server", F.lit(DEFAULT_SERVER)), "repo",
                      F.lit("actions/runs"), "ci_run_id")
    known = filled(F.col("repo")).isNotNull() & filled(F.col("ci_run_id")).isNotNull()
    return runs.withColumns({"branch": F.coalesce(head, ref),
                             "pr": number.try_cast("int"),
                             "run_url": F.when(known, url)})


# Fixed value: where the slug of a remote stands.
SLUG = r"[/:]([^/:]+/[^/]+?)(?:\.git)?$"


def repo_slug(url: Column) -> Column:
    """``owner/repo`` of an https or ssh remote, else NULL."""
    return filled(F.regexp_extract(url, SLUG, 1))


def session_name(repo: Column, fallback: Column, suffix: Column) -> Column:
    """One session per repository, or per suite where a suffix is given."""
    base = F.concat(F.lit("ci/"), F.coalesce(filled(repo), fallback))
    return F.concat(base, F.coalesce(F.concat(F.lit("/"), filled(suffix)), F.lit("")))


def run_label(branch: Column, commit: Column) -> Column:
    """``ci <branch>@<7 digits>``, with ``?`` and ``local`` where unknown."""
    return F.concat(F.lit("ci "), F.coalesce(filled(branch), F.lit("?")), F.lit("@"),
                    F.substring(F.coalesce(filled(commit), F.lit("local")), 1, 7))


def compact_metadata(meta: Column, allowed: Sequence[str] = tuple(META_KEYS)) -> Column:
    """Keep allowlisted keys with a non-empty value."""
    keep = F.array(*[F.lit(k) for k in allowed])
    return F.map_filter(meta, lambda k, v: F.array_contains(keep, k) & v.isNotNull() & (v != ""))


def agent_metadata(agent_meta: Column, repo: Column, branch: Column, commit: Column) -> Column:
    """Agent metadata (map of JSON texts) plus a ``ci`` block when a repo is known."""
    block = F.to_json(F.struct(repo.alias("repo"), branch.alias("branch"), commit.alias("commit_sha")),
                      {"ignoreNullFields": "false"})
    without = F.map_filter(agent_meta, lambda k, v: k != "ci")
    return (F.when(filled(repo).isNotNull(), F.map_concat(without, F.create_map(F.lit("ci"), block)))
            .otherwise(agent_meta))
