"""Canonical JSON text: sorted keys, ``", "`` and ``": "``, ASCII only."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _canonical(text: str | None) -> str | None:
    try:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True)
    except ValueError:
        return None


def _call_key(name: str, tool_input: str) -> str | None:
    try:
        return json.dumps([name, json.loads(tool_input)], sort_keys=True)[:-1]
    except (TypeError, ValueError):
        return None


@F.pandas_udf(StringType())
def _canonical_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_canonical, na_action="ignore")


@F.pandas_udf(StringType())
def _call_key_batch(names: pd.Series, inputs: pd.Series) -> pd.Series:
    return pd.Series(list(map(_call_key, names, inputs)), dtype=object)


def canonical_json(text: Column) -> Column:
    """Canonical form of JSON text. Spark's ``to_json`` neither sorts keys nor
    spaces separators, so nested input crosses to Python once per batch. Text
    that is no JSON gives NULL; `unparsable_json` tells it from a missing one."""
    return _canonical_batch(text)


def unparsable_json(text: Column) -> Column:
    """Whether a text is there but is no JSON."""
    return text.isNotNull() & F.try_parse_json(text).isNull()


def call_key(name: Column, tool_input: Column) -> Column:
    """The part of the hashed text that needs JSON parsing: ``[name, input``."""
    return _call_key_batch(name, tool_input)


def call_hash(name: Column, tool_input: Column, version: Column, seed: Column) -> Column:
    """First 8 hex digits of SHA-256 over ``[name, input, version, seed]``. Only
    the JSON part crosses to Python; hashing stays in the JVM."""
    text = F.concat(call_key(name, tool_input), F.lit(", "), version.cast("string"), F.lit(", "),
                    seed.cast("string"), F.lit("]"))
    return F.substring(F.sha2(text, 256), 1, 8)
