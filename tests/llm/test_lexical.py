"""Ranked lists equal brute force in plain integers; bounds lose nothing."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdictlake.llm import lexical


def terms(text):
    return re.findall(lexical.TERM, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    """{(item, rank): (doc, score)}, every document scored for every item."""
    held = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in docs) if t]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    asked, out = {}, {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    for item, words in asked.items():
        scores = []
        for i, counts, n in held:
            m = 100 - 90 + 90 * n * len(held) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in words if t in counts)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:top], 1):
            out[item, rank] = (i, -score)
    return out


def found(frame, items, **more):
    rows = lexical.ranked_search(frame, items, **more).collect()
    assert len(rows) == len({(r.item_id, r.rank) for r in rows})
    return {(r.item_id, r.rank): (r.doc_id, r.score) for r in rows}


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    docs = [(i, " ".join(words[int(400 * rng.random() ** 3)] for _ in range(rng.choice([1, 5, 40, 300])))) for i in range(n)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for k in range(40)]
    docs += [(n + k, "x " * 50 + text + " y" * 9) for k, (_, text) in enumerate(items[:20])]
    docs += [(5000 + k, docs[3][1]) for k in range(200)]  # copies: ties
    return docs, items


@pytest.mark.parametrize("bucket,block,block_terms", [(2048, 65_536, 200_000), (16, 50, 100)])
def test_lists_equal_brute_force(spark, monkeypatch, bucket, block, block_terms):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "BLOCK_ROWS", block)
    docs, items = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(frame, asked, block_terms=block_terms) == brute(docs, items)


def test_buckets_keep_every_hit_and_prune():
    rng = np.random.default_rng(1)
    size, rows, skipped = 60, 500, 0
    dense = np.where(rng.random((rows, size)) < 0.2, rng.integers(1, 1_000_000, (rows, size)), 0)
    owner, term = np.nonzero(dense)
    bucket = lexical.Bucket(owner, term, dense[owner, term], np.sqrt((dense.astype(float) ** 2).sum(axis=1)), size)
    for _ in range(200):
        own = rng.choice(size, rng.integers(1, 30), replace=False)
        weight = np.sort(rng.integers(1, 9000, len(own)))[::-1]
        scores = dense[:, own] @ weight
        for least in (0, int(np.sort(scores)[-10]), int(scores.max()), int(scores.max()) + 1, 1 << 50):
            got, exact = bucket.search(own, weight, least)
            want = np.flatnonzero((scores >= least) & (scores > 0))
            assert got.tolist() == want.tolist() and exact.tolist() == scores[want].tolist()
            skipped += not len(got)
    assert skipped >= 200


def test_terms():
    text = "Ab-c_É1 \x7f\x00日本 ÉÀ  zz"
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text) == ["ab", "c", "É1", "日本", "ÉÀ", "zz"]


def test_large_sizes_stay_exact():
    value = lexical.impacts(np.array([3, 1]), np.array([10 ** 9, 7]), 10 ** 11, 10 ** 14)
    assert value.tolist() == [1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * n * 10 ** 11 // 10 ** 14)) for tf, n in ((3, 10 ** 9), (1, 7))]


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, " .,- "), (4, "alpha beta"), (4, "alpha beta"), (None, "alpha beta"), (5, "ALPHA gamma " * 3), (6, "alpha " * 60_000 + "delta"), (7, "q"),
            (8, "r"), (9, "s t"), (10, "u")]
    items = [(1, "alpha"), (1, "Beta!"), (2, None), (3, "..."), (4, "unheard"), (None, "gamma"), (None, "delta"), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta")]
    schema = "doc_id long, text string, item_id string, terms string, n string, rank string, score string, block string"
    frame = spark.createDataFrame([(*d, *["z"] * 6) for d in docs], schema).repartition(3)
    asked = spark.createDataFrame([(*i, *["z"] * 6) for i in items], schema.replace("doc_id", "_x").replace("item_id string", "doc_id string").replace("_x", "item_id"))
    assert found(frame, asked) == brute(docs, items) and found(frame, asked, top=2) == brute(docs, items, 2)
    assert found(frame.filter(F.lit(False)), asked) == {} == found(frame, asked.filter(F.lit(False)))
