"""Literal edge rows, a plain-Python twin on random input, and invariants."""

from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from verdictlake.functions import redaction as rd
from verdictlake.functions.canonical import canonical_json
from verdictlake.operators.issues import redact_replies, redact_trace


def column(spark, values, expr):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.x for r in rows.select("i", expr(F.col("t")).alias("x")).orderBy("i").collect()]


PII_ROWS = [
    ("at 152.143.123.131 now", "at <redacted:phone> now"),
    ("host 10.0.0.7", "host <redacted:ip>"),
    ("4785 3805 9239 1139", "<redacted:card>"),
    ("4785380592391139 foo", "<redacted:card>foo"),
    ("mail a.b+c@example.co.uk!", "mail <redacted:email>!"),
    ("ssn 123-45-6789.", "ssn <redacted:ssn>."),
    ("call +1 (555) 1", "call +1 (555) 1"),
    ("call +44 20 7946 0958 now", "call <redacted:phone> now"),
    ("none here 12345678", "none here 12345678"),
    (None, None),
]


def test_pii_rows(spark):
    assert column(spark, [r[0] for r in PII_ROWS], rd.redact_pii) == [r[1] for r in PII_ROWS]


def twin_pii(text: str) -> str:
    for label, pattern in rd.PII_PATTERNS:
        text = re.sub(pattern, label, text, flags=re.ASCII)
    return text


def random_texts(n=1500):
    rng = random.Random(11)
    parts = ["0", "1", "25", "255", ".", "-", " ", "+", "\t", "@", "a", "ex", "com", "x.y", "é", "4785", "123-45-6789",
             "10.0.0.7", "bob@site.org", "\n", "(", "9"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_pii_equals_twin_without_hints(spark):
    """The twin applies every detector to every text: hints lose nothing."""
    texts = random_texts()
    assert column(spark, texts, rd.redact_pii) == [twin_pii(t) for t in texts]


def test_pii_on_the_corpus(spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    clean = column(spark, texts, rd.redact_pii)
    assert clean == [twin_pii(t) for t in texts]
    assert column(spark, clean, rd.redact_pii) == clean


def test_has_pii(spark):
    texts = random_texts(600)
    want = [any(re.search(p, t, re.ASCII) for _, p in rd.PII_PATTERNS) for t in texts]
    assert column(spark, texts, rd.has_pii) == want


TOKEN = "sk-" + "a" * 20


def test_secret_shapes(spark):
    shapes = {
        "api-key": TOKEN, "github": "ghp_" + "A1" * 10, "github-pat": "github_pat_" + "a_1" * 8,
        "aws": "AKIA" + "ABCD1234" * 2, "jwt": "eyJhbGciOiJ.eyJzdWIiOiI.abcd", "slack": "xoxb-" + "12345-abcde",
        "acme": "acme_" + "a" * 12, "custom-0": "f" * 40, "custom-1": "zz-77"}
    texts = [f"use {v} now" for v in shapes.values()]
    got = column(spark, texts, lambda c: rd.redact_secrets(
        c, [r"\b[0-9a-f]{40}\b", r"zz-\d+"], rd.vendor_pattern("acme", ["acme", "voice"])))
    assert got == [f"use [REDACTED:{n}] now" for n in shapes]


def test_secrets_json(spark):
    docs = ['{"ingest_key": "sk-test00000000000000000000fake"}', json.dumps({TOKEN: [1, {"b": TOKEN}]}),
            json.dumps({"m": "x\n" + TOKEN}), '{"n": 1.0, "t": true, "z": null, "u": "é"}', None]
    got = column(spark, docs, lambda c: rd.redact_secrets_json(c))
    assert got == ['{"ingest_key": "[REDACTED:api-key]"}', '{"[REDACTED:api-key]": [1, {"b": "[REDACTED:api-key]"}]}',
                   '{"m": "x\\n[REDACTED:api-key]"}', '{"n": 1.0, "t": true, "z": null, "u": "é"}', None]


@pytest.mark.parametrize("strict, doc, want", [
    (False, '{"ssn": 123456789}', '{"ssn": 123456789}'),
    (False, '{"email": ["a@b.co", "x"]}', '{"email": ["<redacted:email>", "x"]}'),
    (False, '{"filename": "a.txt"}', '{"filename": "<redacted>"}'),
    (False, '{"Account": {"id": "7"}, "note": "10.0.0.7"}', '{"Account": {"id": "7"}, "note": "<redacted:ip>"}'),
    (True, '{"ssn": 123456789}', '{"ssn": "<redacted>"}'),
    (True, '{"email": ["x"]}', '{"email": ["<redacted>"]}'),
    (True, '{"filename": "a.txt"}', '{"filename": "a.txt"}'),
])
def test_pii_json(spark, strict, doc, want):
    assert column(spark, [doc], lambda c: rd.redact_pii_json(c, strict=strict)) == [want]


def test_hook_runs_last(spark):
    assert column(spark, ["Ann a@b.co"], lambda c: rd.redact_pii(c, rd.text_hook(
        lambda t: t.replace("Ann", "<who>")))) == ["<who> <redacted:email>"]
    assert column(spark, ['{"k": "Ann"}'], lambda c: rd.redact_pii_json(
        c, hook=lambda t: t.replace("Ann", "<who>"))) == ['{"k": "<who>"}']


def test_trace_keeps_null_output(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a@b.co")], "trace_id int, turn_idx int, role string, content string")
    events = spark.createDataFrame([(1, 0, '{"email": "x"}', None), (1, 1, "{}", '{"ip": "10.0.0.7"}')],
                                   "trace_id int, seq int, input string, output string")
    clean_turns, clean_events = redact_trace(turns, events)
    assert clean_turns.first().content == "<redacted:email>"
    assert [(r.input, r.output) for r in clean_events.orderBy("seq").collect()] == [
        ('{"email": "<redacted>"}', None), ("{}", '{"ip": "<redacted:ip>"}')]


def test_file_replies_pass_through(spark):
    turns = spark.createDataFrame([("agent", TOKEN, False), ("agent", TOKEN, True), ("user", TOKEN, False)],
                                  "role string, content string, reply_is_file boolean")
    events = spark.createDataFrame([("{}",)], "input string")
    got = [r.content for r in redact_replies(turns, events)[0].collect()]
    assert got == ["[REDACTED:api-key]", TOKEN, TOKEN]


def test_canonical_json(spark):
    docs = ['{"b":1,"a":[1.0,1,true,null]}', '"ü\\ud83d\\ude00"', "7"]
    assert column(spark, docs, canonical_json) == [json.dumps(json.loads(d), sort_keys=True) for d in docs]


def test_oracle_form_equals_twin():
    """The SQL the driver compares with, checked on its own."""
    import duckdb
    from verdictlake.plans.bindings import pii_sql
    texts = random_texts(4000)
    db = duckdb.connect()
    db.execute("CREATE TABLE t (i INT, x VARCHAR)")
    db.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(texts)))
    got = [r[0] for r in db.execute(f"SELECT {pii_sql('x')} FROM t ORDER BY i").fetchall()]
    assert got == [twin_pii(t) for t in texts]
