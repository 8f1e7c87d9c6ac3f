"""Findings in a judge's JSON, whose shape nobody guarantees.

The payload is read as a variant: what is no object, has no ``issues`` list or
lists other things than texts gives no finding, and never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _issues(judge: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(judge), "$.issues", "array<variant>")


def _text(issue: Column) -> Column:
    return F.when(F.schema_of_variant(issue) == "STRING", F.try_variant_get(issue, "$", "string"))


def first_finding(judge: Column) -> Column:
    """The first listed issue if it is a text, else NULL."""
    return _text(F.get(_issues(judge), F.lit(0)))


def findings(judge: Column) -> Column:
    """All listed issues that are texts, in order; NULL without a list."""
    return F.filter(F.transform(_issues(judge), _text), lambda issue: issue.isNotNull())


# What names an agent in its metadata.
AGENT_KEYS = ["name", "version", "model"]


def agent_columns(meta: Column) -> dict[str, Column]:
    """``agent_name``, ``agent_version``, ``agent_model`` of JSON metadata; numbers
    read as texts, what is missing or no JSON as NULL."""
    return {f"agent_{key}": F.get_json_object(meta, f"$.{key}") for key in AGENT_KEYS}


def agent_label(name: str = "agent_name", version: str = "agent_version", model: str = "agent_model") -> Column:
    """``name@version (model)``, with ``?`` for what is unknown."""
    unknown = F.lit("?")
    return F.concat(F.coalesce(name, unknown), F.lit("@"), F.coalesce(version, unknown), F.lit(" ("), F.coalesce(model, unknown), F.lit(")"))
