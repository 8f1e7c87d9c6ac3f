"""The contract columns of the queries without SQL, against plain Python."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from verdictlake.llm import queries

from .test_edges import brute_components


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_op2(spark, sf_dir, texts):
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    first: dict = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    for r in queries.QUERIES["op2_substring_dedup"](spark, sf_dir).collect():
        own, gone = words.pop(r.doc_id), set()
        for k in range(len(own) - 12):
            if first[tuple(own[k:k + 13])] < r.doc_id:
                gone |= set(range(k, k + 13))
        kept = b" ".join(w for k, w in enumerate(own) if k not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(own), len(gone), hashlib.sha256(kept).hexdigest())
    assert not words


def test_op5(spark, sf_dir, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op5_jaccard_components"](spark, sf_dir).collect()}
    assert got == brute_components(list(texts.items()))


def test_op6(spark, sf_dir):
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    ids = np.array(sorted(rows))
    matrix = np.stack([rows[i] for i in ids])
    found: dict = {}
    for r in queries.QUERIES["op6_forest_search"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    assert set(found) == {i for i in rows if i % 20 == 0}
    for q, listed in found.items():
        assert [rank for rank, _, _ in listed] == list(range(1, len(listed) + 1)) and all(i != q for _, i, _ in listed)
        assert np.allclose([s for *_, s in listed], [rows[q] @ rows[i] for _, i, _ in listed], rtol=1e-12)
        assert [(-s, i) for _, i, s in listed] == sorted((-s, i) for _, i, s in listed)
        scores = matrix @ rows[q]
        scores[ids == q] = -np.inf
        best = set(ids[np.argsort(-scores)[:20]].tolist())
        hits, total = hits + len(best & {i for _, i, _ in listed}), total + min(20, len(ids) - 1)
    assert hits >= 0.9 * total


def test_op7(spark, sf_dir, texts):
    rows = queries.QUERIES["op7_language_id"](spark, sf_dir).collect()
    learned = {r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang").distinct().collect()} - {None}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spelled = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in learned if spelled else r.lang_pred == "und"
