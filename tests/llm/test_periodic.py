"""Runs equal those of brute force; planting and digests equal plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdictlake.llm import periodic


def plain_runs(words):
    """(start, length, period) of every run, by every lag at every place."""
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start:start + length]
            if length >= max(12, 2 * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                found.add((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def texts():
    rng = random.Random(3)
    out = [[], ["a"], list("a" * 11), list("a" * 12), list("ab" * 6), list("ab" * 200), list("abc" * 4), list("abcdef" * 2) + ["x"],
           list("abcdefg" * 2), list("aaab" * 3), list("aaaaaaaaaaaab" * 9), ["a"] * 300 + ["b"] + ["a"] * 299 + ["b"] + ["a"] * 300]
    # Every piece of two blocks comes at least twice in the root, so that no seed's next occurrence is one period on.
    a, b = [f"a{i}" for i in range(9)], [f"b{i}" for i in range(8)]
    root = [w for c in "AABBAABBAB" for w in (a if c == "A" else b)]
    out += [root * 2, ["x"] + root * 3 + ["y"] + root[:30]]
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    out.append(list(fib[-1]))
    for _ in range(150):
        letters = "abcdefghij"[:rng.choice([1, 2, 3, 10])]
        words = [rng.choice(letters) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            at, size = rng.randrange(len(words) + 1), rng.randrange(1, 40)
            words[at:at] = (words[at:at + size] or ["z"]) * rng.choice([1, 2, 2, 3, 7])
        out.append(words[:400])
    return out


def test_runs_equal_brute_force():
    rows = texts()
    names = {w: n for n, w in enumerate(sorted({w for r in rows for w in r}))}
    numbers = np.array([names[w] for r in rows for w in r], np.int64)
    got = {}
    for t, start, period, length in periodic.find_runs(numbers, np.array([len(r) for r in rows])):
        got.setdefault(t, []).append((start, length, period))
    for t, words in enumerate(rows):
        assert got.get(t, []) == plain_runs(words), " ".join(words)


def test_hash_collisions_only_cost_time(monkeypatch):
    rows = texts()[:40]
    names = {w: n for n, w in enumerate(sorted({w for r in rows for w in r}))}
    numbers, sizes = np.array([names[w] for r in rows for w in r], np.int64), np.array([len(r) for r in rows])
    want = periodic.find_runs(numbers, sizes)
    at = periodic.Grams.at
    monkeypatch.setattr(periodic.Grams, "at", lambda self, p, k: at(self, p, k) % np.uint64(3) + self.owner[p] % np.uint64(1 << 60) * np.uint64(8))
    # Chains are made of hashes, so only whole classes of near lags stay exact under made-up collisions.
    got = periodic.find_runs(numbers, sizes)
    assert [r for r in got if r[2] < 12] == [r for r in want if r[2] < 12] and set(got) <= set(want)


def planted_words(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_plain_python(spark, sf_dir):
    import __spark_entry__ as entry_point
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = entry_point.queries()["op13_periodic_runs"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    hits = 0
    for r in rows:
        words = [w.decode() for w in (docs[r.doc_id] or "").encode().split()]
        if len(words) > 700:  # brute force is slow on these; the next test holds long texts
            continue
        words = planted_words(r.doc_id, words)
        runs = plain_runs(words)
        top = min(((-length, start, q) for start, length, q in runs), default=None)
        want = (len(runs), *((top[1], -top[0], top[2], 1000 * -top[0] // top[2]) if top else [None] * 4),
                sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(collapsed(words, runs))))
        assert tuple(r)[1:] == want, r.doc_id
        hits += bool(runs)
    assert hits > 5


def test_long_texts_and_edges(spark):
    base = [f"w{i}" for i in range(5000)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 50_000), (5, " ".join(base * 3)), (6, "x " + " ".join(base * 2) + " y"),
            (None, "a b " * 9), (7, "x y z"), (7, "x y z"), (8, " ".join(["u", "v"] * 30_000 + base + ["u", "v"] * 30_000)), (9, "é " * 12)]
    frame = spark.createDataFrame([(*r, "q", 1) for r in rows], "doc_id long, text string, runs string, n_words int").repartition(3)
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(frame).collect()}
    assert got[1, 0] == got[2, 0] == got[3, 0] == ([], "")
    assert got[4, 50_000] == ([(0, 50_000, 1)], "a")
    assert got[5, 15_000] == ([(0, 15_000, 5000)], " ".join(base))
    assert got[6, 10_002] == ([(1, 10_000, 5000)], "x " + " ".join(base) + " y")
    assert got[None, 18] == ([(0, 18, 2)], "a b") and got[7, 3] == ([], "x y z") and got[9, 12] == ([(0, 12, 1)], "é")
    assert got[8, 125_000] == ([(0, 60_000, 2), (65_000, 60_000, 2)], " ".join(["u", "v", *base, "u", "v"]))
    assert periodic.periodic_runs(frame.filter(F.lit(False))).collect() == []


@pytest.mark.parametrize("n", [1, 2, 12, 97, 360])
def test_prime_factors(n):
    assert list(periodic.prime_factors(n)) == [p for p in range(2, n + 1) if n % p == 0 and all(p % k for k in range(2, p))]
