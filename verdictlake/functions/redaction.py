"""Redaction of secrets and personal data.

Plain text stays in chained ``regexp_replace`` expressions. Nested JSON must be
parsed before it is scrubbed (serialised escapes hide word boundaries, numbers
must stay), so it crosses to Python once per Arrow batch.

Digits and white space are ASCII, word boundaries Unicode-aware, in both forms.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes and labels must equal the reference's.
SECRET_PATTERNS = [
    ("api-key", r"\bsk-[A-Za-z0-9_-]{16,}\b"),
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{20,}\b"),
    ("github-pat", r"\bgithub_pat_[A-Za-z0-9_]{20,}\b"),
    ("aws", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\b"),
    ("slack", r"\bxox[baprs]-[A-Za-z0-9-]{10,}\b"),
]
# Detectors in order, a card before a phone before an address.
PII_PATTERNS = [
    ("<redacted:email>", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("<redacted:ssn>", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
    ("<redacted:card>", r"(?<!\d)(?:\d[ -]?){13,19}(?!\d)"),
    ("<redacted:phone>", r"(?<!\d)(?:\+?\d[\s.-]?){9,14}\d(?!\d)"),
    ("<redacted:ip>", r"(?<!\d)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}"
                      r"(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d)"),
]
# Cheap tests every match of a detector group passes: most texts stop here. A
# card, phone or social security number has nine digits at most two apart.
SECRET_HINT = r"sk-|gh[pousr]_|github_pat_|AKIA|ASIA|eyJ|xox[baprs]-"
NINE_DIGITS_HINT = r"\d(?:\D{0,2}\d){8}"
IP_HINT = r"\d\.\d"
# Parts of sensitive keys, and what replaces their texts.
SENSITIVE_KEY = "email|phone|ssn|dob|birth|address|name|card|account|token|secret|password"
MASK = "<redacted>"


def vendor_pattern(name: str, prefixes: Sequence[str]) -> tuple[str, str]:
    """A named shape for tokens of the form ``<prefix>_<12 or more alphanumerics>``."""
    return name, r"\b(?:" + "|".join(map(re.escape, prefixes)) + r")_[A-Za-z0-9]{12,}\b"


def secret_patterns(extra: Sequence[str] = (),
                    vendor: tuple[str, str] | None = None) -> list[tuple[str, str]]:
    """Built-ins, then the vendor shape, then user patterns named by position."""
    named = [*SECRET_PATTERNS, *([vendor] if vendor else [])]
    return named + [(f"custom-{i}", p) for i, p in enumerate(extra)]


def _replace(text: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    for label, pattern in patterns:
        text = F.regexp_replace(text, pattern, label)
    return text


def redact_secrets(text: Column, extra: Sequence[str] = (),
                   vendor: tuple[str, str] | None = None) -> Column:
    """Replace secret-shaped substrings with ``[REDACTED:<name>]``."""
    labelled = [(f"[REDACTED:{n}]", p) for n, p in secret_patterns(extra, vendor)]
    split = len(SECRET_PATTERNS)
    hinted = F.when(text.rlike(SECRET_HINT), _replace(text, labelled[:split])).otherwise(text)
    return _replace(hinted, labelled[split:])


def _pii_groups(text: Column) -> list[tuple[Column, list[tuple[str, str]]]]:
    """Detectors in order, grouped by the cheap test on the original text that
    decides whether the group runs. Replacements only ever remove digits, so the
    test stays valid for what earlier groups leave behind."""
    return [(text.contains("@"), PII_PATTERNS[:1]),
            (text.rlike(NINE_DIGITS_HINT), PII_PATTERNS[1:4]),
            (text.rlike(IP_HINT), PII_PATTERNS[4:])]


def redact_pii(text: Column, hook: Callable[[Column], Column] | None = None,
               only: Sequence[str] | None = None) -> Column:
    """Mask structured personal data; ``hook`` runs after the built-ins. ``only``
    names the labels to apply, by default all."""
    clean = text
    for hint, group in _pii_groups(text):
        wanted = [(label, p) for label, p in group if only is None or label in only]
        if wanted:
            clean = F.when(hint, _replace(clean, wanted)).otherwise(clean)
    return hook(clean) if hook else clean


def has_pii(text: Column) -> Column:
    """True where any detector still matches."""
    found = F.lit(False)
    for hint, group in _pii_groups(text):
        hit = F.lit(False)
        for _, pattern in group:
            hit = hit | text.rlike(pattern)
        found = found | (hint & hit)
    return found


def text_hook(fn: Callable[[str], str]) -> Callable[[Column], Column]:
    """Wrap a user's ``str -> str`` as a batch function for ``redact_pii``."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fn, na_action="ignore")
    return run


def _substitute(patterns: Sequence[tuple[str, str]], flags: int = 0) -> Callable[[str], str]:
    compiled = [(re.compile(p, flags), label) for label, p in patterns]

    def run(text: str) -> str:
        for regex, label in compiled:
            text = regex.sub(lambda _m, label=label: label, text)
        return text
    return run


SLICE = 256


def _json_batches(walk: Callable, columns: Sequence[Column]) -> Column | list[Column]:
    """Send all JSON columns through one Python crossing; get them back in order.
    Of a batch only ``SLICE`` texts at a time are Python objects."""
    def each(text):
        try:
            return None if text is None else json.dumps(walk(json.loads(text)), ensure_ascii=False)
        except ValueError:  # never pass raw text on
            return None

    def scrubbed(texts: pa.Array) -> pa.Array:
        parts = [pa.array([each(t) for t in texts.slice(at, SLICE).to_pylist()], pa.string()) for at in range(0, len(texts), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    if len(columns) == 1:
        @F.arrow_udf("string")
        def one(texts: pa.Array) -> pa.Array:
            return scrubbed(texts)
        return one(columns[0])

    names = [f"c{i}" for i in range(len(columns))]

    @F.arrow_udf(f"struct<{', '.join(f'{n} string' for n in names)}>")
    def many(*arrays: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([scrubbed(a) for a in arrays], names)
    out = many(*columns)
    return [out.getField(n) for n in names]


def redact_secrets_json(*columns: Column, extra: Sequence[str] = (),
                        vendor: tuple[str, str] | None = None) -> Column | list[Column]:
    """Scrub every string of JSON text, object keys included. Digits, words and
    white space in patterns are ASCII, as in `redact_secrets`. Text that is no
    JSON gives NULL; `canonical.unparsable_json` flags it."""
    scrub = _substitute([(f"[REDACTED:{n}]", p) for n, p in secret_patterns(extra, vendor)], re.ASCII)

    def walk(value):
        match value:
            case str():
                return scrub(value)
            case dict():
                return {scrub(k): walk(v) for k, v in value.items()}
            case list():
                return [walk(v) for v in value]
        return value
    return _json_batches(walk, columns)


def redact_pii_json(*columns: Column, hook: Callable[[str], str] | None = None,
                    strict: bool = False) -> Column | list[Column]:
    """Mask personal data in JSON text; text that is no JSON gives NULL.

    A string directly under a sensitive key is masked whole; inside a list the
    key no longer counts; numbers and keys stay. ``strict`` closes those gaps:
    the key must match as a whole word, reaches into lists, and masks numbers.
    """
    scrub = _substitute(PII_PATTERNS, re.ASCII)
    sensitive = re.compile(rf"(?:^|[_\W])(?:{SENSITIVE_KEY})(?:$|[_\W])" if strict
                           else SENSITIVE_KEY, re.IGNORECASE)

    def walk(value, key=None):
        hot = key is not None and sensitive.search(key) is not None
        if isinstance(value, str):
            if hot:
                return MASK
            clean = scrub(value)
            return hook(clean) if hook else clean
        if isinstance(value, dict):
            return {k: walk(v, k) for k, v in value.items()}
        if isinstance(value, list):
            return [walk(v, key if strict else None) for v in value]
        if strict and hot and value is not None and not isinstance(value, bool):
            return MASK
        return value
    return _json_batches(walk, columns)
