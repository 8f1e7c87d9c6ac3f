"""Block-wise ordered operators against brute force, hot groups included."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from verdictlake.operators.ordered import carry_last, equal_blocks, number_block, positions, prefix_sums, segmented_sums
from verdictlake.operators.usage import nearest_rank


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    data, seen = [], set()
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}"
        order = rng.randrange(5000)
        if (key, order) not in seen:
            seen.add((key, order))
            data.append((key, order, rng.randrange(-5, 9), rng.choice([None, "a", "b", "c"])))
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, ord bigint, n bigint, tag string")


def groups(rows):
    out = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[0], r[1])):
        out[row[0]].append(row)
    return out


@pytest.mark.parametrize("bits", [2, 6, 30])
def test_prefix_sums(frame, rows, bits):
    got = {(r.key, r.ord): r.before for r in prefix_sums(
        frame, ["key"], ["ord"], number_block("ord", bits), before=F.col("n")).collect()}
    want = {}
    for key, members in groups(rows).items():
        total = 0
        for _, order, n, _ in members:
            want[key, order] = total
            total += n
    assert got == want


@pytest.mark.parametrize("bits", [2, 5, 30])
def test_segmented_sums(frame, rows, bits):
    got = {(r.key, r.ord): (r.one, r.two) for r in segmented_sums(
        frame, ["key"], ["ord"], number_block("ord", bits), F.col("tag") == "a", one=F.col("n"), two=F.lit(1)).collect()}
    want = {}
    for key, members in groups(rows).items():
        total = count = 0
        for _, order, n, tag in members:
            if tag == "a":
                total = count = 0
            want[key, order] = (total, count)
            total, count = total + n, count + 1
    assert got == want


def test_restart_carries_over_blocks_without_marks(spark):
    marked = {0, 700, 4000}
    frame = spark.range(5000).select(F.lit(1).alias("key"), F.col("id").alias("ord"), F.col("id").isin(*marked).alias("mark"))
    got = segmented_sums(frame, ["key"], ["ord"], number_block("ord", 4), F.col("mark"), before=F.lit(1)).collect()
    assert {r.ord: r.before for r in got} == {i: i - max(m for m in marked if m <= i) for i in range(5000)}


def hot_day(spark):
    """One session with most rows, within one day, a third of them at one instant."""
    at = F.expr("timestamp'2024-03-05 09:00:00' + make_dt_interval(0, 0, 0, case when id % 3 = 0 then 7200 else id % 20000 end)")
    hot = spark.range(20_000).select(F.lit("hot").alias("key"), at.alias("at"), F.col("id"))
    return hot.unionByName(spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 30).alias("key"), at.alias("at"), F.col("id")))


def test_one_hot_day_has_many_equal_blocks(spark):
    blocked = equal_blocks(hot_day(spark), ["key"], ["at", "id"], rows=500)
    sizes = {}
    for r in blocked.groupBy("key", "_block").count().collect():
        sizes.setdefault(r.key, []).append(r["count"])
    assert 20 <= len(sizes["hot"]) <= 80 and max(sizes["hot"]) <= 1500 and sum(sizes["hot"]) == 20_000
    assert all(len(blocks) <= 1 for key, blocks in sizes.items() if key != "hot")


def test_equal_blocks_follow_the_order(spark):
    blocked = equal_blocks(hot_day(spark), ["key"], ["at", "id"], rows=500)
    got = {(r.key, r.at, r.id): r.pos for r in positions(blocked, ["key"], ["at", "id"], F.col("_block"), "pos").collect()}
    assert len(got) == 20_300
    for key, members in groups([(*k, p) for k, p in got.items()]).items():
        assert [m[3] for m in sorted(members)] == list(range(len(members))), key


def test_equal_blocks_with_nulls_texts_and_without_rows(spark):
    rows = [("a", None, f"t{i:03}") for i in range(400)] + [("a", i, "é") for i in range(400)]
    frame = spark.createDataFrame(rows, "key string, at long, name string").repartition(3)
    blocked = equal_blocks(frame, ["key"], ["at", "name"], rows=20).collect()
    in_order = sorted(blocked, key=lambda r: (r.at is not None, r.at or 0, r.name))
    assert [r["_block"] for r in in_order] == sorted(r["_block"] for r in blocked) and len({r["_block"] for r in blocked}) > 20
    assert equal_blocks(frame.filter("key = 'z'"), ["key"], ["at"], rows=10).collect() == []


@pytest.mark.parametrize("bits", [2, 30])
def test_carry_last(frame, rows, bits):
    got = {(r.key, r.ord): r.prev for r in carry_last(
        frame, ["key"], ["ord"], number_block("ord", bits), F.col("tag"), "prev").collect()}
    want = {}
    for key, members in groups(rows).items():
        last = None
        for _, order, _, tag in members:
            want[key, order] = last
            last = tag if tag is not None else last
    assert got == want


def test_partitioning_and_row_order_do_not_matter(frame):
    def result(df):
        return sorted(map(tuple, positions(df, ["key"], ["ord"], number_block("ord", 4), "pos").collect()))
    assert result(frame.orderBy(F.rand(1)).repartition(7)) == result(frame.coalesce(1))


def test_nearest_rank(frame, rows):
    got = {r.key: r.q for r in nearest_rank(frame, ["key"], "n", 0.95, "q").collect()}
    want = {k: sorted(m[2] for m in members)[math.ceil(0.95 * len(members)) - 1] for k, members in groups(rows).items()}
    assert got == want
