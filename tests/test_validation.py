from __future__ import annotations

import random
from collections import Counter
from hashlib import md5, sha256

import pytest
from pyspark.sql import functions as F

from verdictlake.operators import validation as v


@pytest.fixture(scope="module")
def pool(spark):
    return spark.range(1000).select(
        F.col("id").alias("scenario_id"),
        F.when(F.col("id") < 700, "big").when(F.col("id") < 995, "mid").otherwise("tiny").alias("task_family"))


@pytest.fixture(scope="module")
def weights(spark):
    return spark.createDataFrame([("big", 0.2), ("mid", 0.3), ("tiny", 0.5)], "task_family string, weight double")


@pytest.mark.parametrize("count", [0, 1, 7, 100, 999, 1000, 1500])
def test_sample_is_exact(pool, weights, count):
    rows = v.sample_scenarios(pool, weights, count, seed=3).collect()
    assert len(rows) == min(count, 1000) == len({r.scenario_id for r in rows})
    if count == 100:
        # tiny has only five; its remainder goes to the family with most left.
        assert Counter(r.task_family for r in rows) == {"big": 65, "mid": 30, "tiny": 5}


def test_sample_is_deterministic(pool, weights):
    def ids(df, seed):
        return {r.scenario_id for r in v.sample_scenarios(df, weights, 50, seed).collect()}
    assert ids(pool, 1) == ids(pool.repartition(5).orderBy(F.desc("scenario_id")), 1) != ids(pool, 2)


def test_duplicates_within_a_representation(spark):
    rows = spark.createDataFrame([(1, "a", "Hello, World"), (2, "a", "hello world!"), (3, "b", "hello world"), (4, "a", "x")],
                                 "scenario_id int, representation_id string, text string")
    got = {r.scenario_id: r.is_duplicate for r in v.mark_duplicate_scenarios(rows).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}


def test_duplicates_of_one_id(spark):
    rows = spark.createDataFrame([(1, "a", "x y"), (2, "a", "X, y!"), (2, "a", "other"), (2, "a", None), (None, "a", "x y"), (3, None, "x y"), (4, None, "x y")],
                                 "scenario_id int, representation_id string, text string")
    got = sorted((str(r.scenario_id), str(r.text), r.is_duplicate) for r in v.mark_duplicate_scenarios(rows).collect())
    assert got == [("1", "x y", False), ("2", "None", False), ("2", "X, y!", True), ("2", "other", False), ("3", "x y", False), ("4", "x y", False), ("None", "x y", False)]


def test_diversity(spark):
    rows = spark.createDataFrame([("d", "f", "a b"), ("d", "f", "B a"), ("d", "g", "a b!"), ("d", "g", "c")],
                                 "dataset_id string, task_family string, text string")
    row = v.validation_diversity(rows).first()
    assert (row.scenarios, row.distinct_share, row.family_entropy, row.near_duplicate_share) == (4, 0.75, 1.0, 0.5)


def edited_texts(seed=2, bases=30, copies=8):
    """(set id, words): texts of 30 to 200 words with copies of a few changed words."""
    rng, rows = random.Random(seed), []
    for b in range(bases):
        words = [f"b{b}w{i}" for i in range(rng.randrange(30, 200))]
        rows.append((f"{b:03}-0", words))
        for c in range(1, copies):
            changed = list(words)
            for i in rng.sample(range(len(words)), rng.choice([1, 1, 2, len(words) // 12, len(words) // 5, len(words) // 2])):
                changed[i] = f"x{b}c{c}i{i}"
            rows.append((f"{b:03}-{c}", changed))
    return [(i, sorted(set(w))) for i, w in rows]


def test_near_links(spark):
    rows = edited_texts()
    bags = {i: set(w) for i, w in rows}
    frame = spark.createDataFrame([("d", i, w) for i, w in rows], "dataset_id string, set_id string, words array<string>").repartition(4)
    links = {(r.set_id, r.earlier) for r in v.near_links(frame, ["dataset_id"]).collect()}

    def alike(a, b):
        return len(bags[a] & bags[b]) / len(bags[a] | bags[b])
    assert all(b < a and alike(a, b) >= 0.8 for a, b in links)
    found = {a for a, _ in links}
    near = {a for a in bags for b in bags if b < a and alike(a, b) >= 0.8}
    assert found <= near and len(found) >= 0.97 * len(near) > 50
    # A text with one changed word is always found.
    assert {a for a in bags if a[-1] != "0" and len(bags[a] ^ bags[a[:3] + "-0"]) == 2} <= found


def test_signatures_estimate_jaccard(spark):
    rows = edited_texts(seed=5)
    frame = spark.createDataFrame(rows, "set_id string, words array<string>")
    signs = {r.set_id: set(r.s) for r in v.min_hashes(frame, "words", "s").collect()}
    bags, errors = {i: set(w) for i, w in rows}, []
    for i in bags:
        base = i[:3] + "-0"
        bins = len({m[0] + "0123456789abcdef"[int(m[1], 16) // 4] for m in signs[i] | signs[base]})
        errors.append(len(signs[i] & signs[base]) / bins - len(bags[i] & bags[base]) / len(bags[i] | bags[base]))
    # 64 bins: a standard error of at most 0.0625.
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.0625 and abs(sum(errors) / len(errors)) < 0.02


def test_signatures_equal_plain_python(spark):
    rows = edited_texts(seed=7, bases=5) + [("none", None), ("empty", []), ("blank", [""]), ("é", ["é", "ß"])]
    got = {r.set_id: r.s for r in v.min_hashes(spark.createDataFrame(rows, "set_id string, words array<string>").repartition(3), "words", "s").collect()}
    for i, words in rows:
        least = {}
        for mark in sorted(md5(w.encode()).hexdigest() for w in words or []):
            least.setdefault(int(mark[:2], 16) >> 2, mark)
        assert got[i] == (None if words is None else list(least.values()))


def test_signatures_are_made_once_and_words_looked_up_by_size(spark):
    """what a link is found by is stored; no later step makes it again, and a
    pair that its sizes keep apart is dropped before words are looked up."""
    small = sorted(f"w{i}" for i in range(4))
    rows = [("d", "0", small), ("d", "1", small + [f"x{i}" for i in range(40)])] + [("d", "2", sorted(small + ["v"]))] * 3
    frame = spark.createDataFrame(rows, "dataset_id string, set_id string, words array<string>")
    links = v.near_links(frame, ["dataset_id"])
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "_least_marks" not in plan and "xxhash64" not in plan
    assert {(r.set_id, r.earlier) for r in links.collect()} == {("2", "0")}


def test_planted_edits_count_as_near(spark):
    base = [" ".join(f"t{k}w{i}" for i in range(40)) for k in range(10)]
    edits = [t.replace("w7", "changed").upper() + "!" for t in base]
    rows = spark.createDataFrame([("d", "f", t) for t in base + edits + base[:2]] + [("e", "f", t) for t in base], "dataset_id string, task_family string, text string")
    got = {r.dataset_id: r for r in v.validation_diversity(rows).collect()}
    assert got["d"].near_duplicate_share == 12 / 22 and got["d"].distinct_share == 20 / 22 and got["e"].near_duplicate_share == 0


def all_links(bags, threshold):
    return {(a, b) for a in bags for b in bags if b < a and bags[a] and len(bags[a] & bags[b]) / len(bags[a] | bags[b]) >= threshold}


def small_sets(seed=11, sets=250, vocabulary=14):
    """Sets of 0 to 8 words out of few, so that many pairs lie at the threshold."""
    rng = random.Random(seed)
    return {f"{i:03}": {f"w{k}" for k in rng.sample(range(vocabulary), rng.randrange(9))} for i in range(sets)}


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_every_link_is_found(spark, monkeypatch, threshold):
    """no pair that meets the threshold is left out, whatever the least set of a
    band is; blocks of a common word meet in pairs."""
    monkeypatch.setattr(v, "BLOCK", 7)
    monkeypatch.setattr(v, "SLICE", 100)
    monkeypatch.setattr(v, "CELL", 5)
    for bags in (small_sets(), {i: set(w) for i, w in edited_texts(seed=3, bases=12)}):
        rows = [(d, i, sorted(w)) for d in ("d", "e", None) for i, w in bags.items() if d != "e" or i < "100"] + [("d", "none", None), ("d", None, ["w1"])]
        frame = spark.createDataFrame(rows, "dataset_id string, set_id string, words array<string>").repartition(3)
        links = [(r.dataset_id, r.set_id, r.earlier) for r in v.near_links(frame, ["dataset_id"], threshold).collect()]
        want = all_links(bags, threshold)
        assert sorted(links) == sorted([("d", a, b) for a, b in want] + [("e", a, b) for a, b in want if a < "100"])


def test_links_across_words_without_a_rare_one(spark):
    """sets of which every word is common are linked as well, and 0 is no threshold."""
    frame = spark.createDataFrame([("d", "a", ["p", "q", "r", "s"]), ("d", "b", ["p", "q", "r", "s", "t"]), ("d", "c", ["p", "q", "r", "t"]), ("d", "d", ["p", "q", "s", "t"]),
                                   ("d", "e", ["q", "r", "s", "t"])], "dataset_id string, set_id string, words array<string>")
    assert {(r.set_id, r.earlier) for r in v.near_links(frame, ["dataset_id"]).collect()} == {("b", "a"), ("c", "b"), ("d", "b"), ("e", "b")}
    with pytest.raises(ValueError):
        v.near_links(frame, ["dataset_id"], 0.0)


def test_diversity_counts_every_linked_set(spark):
    """the share is that of comparing each set with all that stand before it."""
    bags = {i: b for i, b in small_sets(seed=4).items() if b}
    texts = [" ".join(sorted(b)) for b in bags.values()]
    rows = spark.createDataFrame([("d", "f", t) for t in texts], "dataset_id string, task_family string, text string")
    named = {sha256(t.encode()).hexdigest(): b for t, b in zip(texts, bags.values())}
    linked = {a for a, _ in all_links(named, 0.8)}
    assert v.validation_diversity(rows).first().near_duplicate_share == (len(texts) - len(named) + len(linked)) / len(texts)


def test_copies_make_no_pairs(spark):
    rows = spark.range(3000).select(F.lit("d").alias("dataset_id"), F.lit("f").alias("task_family"),
                                    F.when(F.col("id") % 3 > 0, "one very common text").otherwise(F.concat(F.lit("own text "), F.col("id"))).alias("text"))
    row = v.validation_diversity(rows).first()
    assert row.scenarios == 3000 and row.near_duplicate_share >= 1999 / 3000


def test_fidelity(spark):
    rows = spark.createDataFrame([("d", "f"), ("d", "f")], "dataset_id string, fam string")
    other = spark.createDataFrame([("d", "g")], "dataset_id string, fam string")
    same, apart = v.validation_fidelity(rows, rows, "fam").first(), v.validation_fidelity(rows, other, "fam").first()
    assert (same.total_variation, same.js_divergence) == (0.0, 0.0)
    assert (apart.total_variation, apart.js_divergence) == (1.0, 1.0)


def test_verdict(spark):
    rows = spark.createDataFrame([(1, 0.95, 0.1, 0.9), (2, 0.95, 0.3, 0.9), (3, None, 0.1, 0.9)],
                                 "dataset_id int, validity double, total_variation double, distinct_share double")
    assert [r.verdict for r in v.validation_verdict(rows).orderBy("dataset_id").collect()] == ["pass", "warn", "warn"]
