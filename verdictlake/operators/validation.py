"""Scenario-set quality: validity, fidelity, diversity, duplicates, sampling.

Only the shapes follow the reference; the formulas are ours and published:
total variation distance, Jensen-Shannon divergence (base 2), Shannon entropy,
largest-remainder apportionment (Hamilton's method).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from verdictlake.operators.scorecard import rate_of
from verdictlake.session import written


def validation_validity(validations: DataFrame, by: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Share of judged scenarios that pass the gate."""
    return (validations.groupBy(*by)
            .agg(F.count("passed").alias("judged"), F.count_if("passed").alias("valid"))
            .withColumn("validity", rate_of(F.col("valid"), F.col("judged"))))


def _mix(rows: DataFrame, keys: Sequence[str], item: str, out: str) -> DataFrame:
    """Share of each item within its group; windows run over item counts only."""
    counts = rows.groupBy(*keys, item).agg(F.count("*").cast("double").alias("n"))
    return counts.select(*keys, item, (F.col("n") / F.sum("n").over(Window.partitionBy(*keys))).alias(out))


def validation_fidelity(dataset: DataFrame, reference: DataFrame, item: str,
                        key: str = "dataset_id") -> DataFrame:
    """Distance between a dataset's mix of ``item`` and the reference mix of the
    same key."""
    both = (_mix(dataset, [key], item, "p").join(_mix(reference, [key], item, "q"), [key, item], "full")
            .withColumns({"p": F.coalesce("p", F.lit(0.0)), "q": F.coalesce("q", F.lit(0.0))})
            .withColumn("m", (F.col("p") + F.col("q")) / 2))

    def part(share: str) -> Column:
        return F.when(F.col(share) > 0, F.col(share) * F.log2(F.col(share) / F.col("m"))).otherwise(0.0)

    return both.groupBy(key).agg(
        (F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("total_variation"),
        (F.sum(part("p") + part("q")) / 2).alias("js_divergence"))


def normal_text(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def word_array(normal: Column) -> Column:
    """Distinct words of a normal text in order: equal for texts that differ in
    case, punctuation, word order or repetition."""
    return F.sort_array(F.array_distinct(F.split(normal, " ")))


NEAR = 0.8
BINS = 64


@F.arrow_udf(ArrayType(StringType()))
def _least_marks(words: pa.Array) -> pa.Array:
    """The least MD5 of each bin of each array; a word that a batch repeats is hashed once."""
    coded = pc.list_flatten(words).dictionary_encode()
    digests = sorted((md5(w).hexdigest(), i) for i, w in enumerate(coded.dictionary.cast(pa.binary()).to_pylist()))
    marks = pa.array([m for m, _ in digests], pa.string())
    rank, bins = np.empty(len(marks), np.int64), np.empty(len(marks), np.int64)
    for place, (mark, i) in enumerate(digests):
        rank[i], bins[i] = place, int(mark[:2], 16) * BINS >> 8
    known = pc.is_valid(coded.indices)
    codes = coded.indices.filter(known).to_numpy(zero_copy_only=False)
    rows = pc.list_parent_indices(words).filter(known).to_numpy(zero_copy_only=False)
    least = np.full(len(words) * BINS, len(marks), np.int64)
    np.minimum.at(least, rows * BINS + bins[codes], rank[codes])
    held = least < len(marks)
    ends = np.cumsum(held.reshape(-1, BINS).sum(axis=1))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), marks.take(pa.array(least[held])), mask=words.is_null())


def min_hashes(words: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out``: a one-permutation MinHash signature of the word arrays in
    ``column``. The first six bits of a word's MD5 pick one of 64 bins; the least
    MD5 of each bin, in order, is the signature (Li et al. 2012). Two sets share a
    bin's least value with a chance of their Jaccard similarity.
    """
    return words.withColumn(out, _least_marks(column))


def jaccard(one: Column, other: Column) -> Column:
    """Similarity of two arrays of distinct values."""
    shared = F.array(F.size(F.array_intersect(one, other)))  # bound by a lambda, so that it is counted once
    return F.transform(shared, lambda n: n.cast("double") / (F.size(one) + F.size(other) - n))[0]


SLOT_BITS = 20
PARITY_WORDS = 8
BLOCK = 4096
CELL = 128
ASKED_BITS = 24
SLICE = 1 << 20


def least_shared(total: Column, threshold: float) -> Column:
    """How many words two sets of ``total`` words together share at least, if they
    are ``threshold`` alike; never too many by rounding."""
    return F.ceil(total * F.lit(threshold / (1 + threshold)) - F.lit(1e-6))


def word_levels(tokens: DataFrame) -> np.ndarray:
    """How common words are, by slot of their hash (``token``): eight levels to an
    octave, 0 where all sets hold one word of the slot. A fixed number of slots goes
    to the driver. Levels order words, rare ones first; any order gives the same links."""
    counts = tokens.groupBy(F.shiftrightunsigned("token", 64 - SLOT_BITS).cast("int").alias("slot")).agg(F.count("*").alias("n"))
    found = counts.filter("n > 1").select("slot", F.least(F.round(F.log2("n") * 8), F.lit(255)).cast("smallint").alias("level")).toArrow()
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    levels[found["slot"].to_numpy()] = found["level"].to_numpy()
    return levels


def rare_words(levels: np.ndarray, threshold: float) -> Callable[[str], Column]:
    """Of arrays of word hashes, ``rare``: so many of the rarest that sets which are
    ``threshold`` alike share one (NULL in the place of one that no other set holds),
    and ``parity``: which of 512 slots hold an odd number of them all."""
    longs = pa.list_(pa.field("element", pa.int64()))
    bits = 64 * PARITY_WORDS

    def lists(sizes: list[np.ndarray], values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)), values, type=longs)

    @F.arrow_udf("struct<rare: array<bigint>, parity: array<bigint>>")
    def described(tokens: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.list_flatten(tokens).to_numpy(zero_copy_only=False).view(np.uint64)
        ends, first = np.cumsum(sizes), 0
        lengths, found, single, odd = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)]
        while first < len(sizes):
            done = ends[first] - sizes[first]
            last = min(max(first + 1, int(np.searchsorted(ends, done + SLICE, "right"))), first + 2048)
            own, n = flat[done:ends[last - 1]], sizes[first:last]
            rows = np.repeat(np.arange(len(n)), n)
            level = levels[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            order = np.lexsort((own, level, rows))
            length = np.clip(n - np.ceil(threshold * n - 1e-6).astype(np.int64) + 1, 0, n)
            kept = order[np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) < np.repeat(length, n)]
            lengths.append(length), found.append(own[kept]), single.append(level[kept] == 0)
            slots = np.bincount(rows * bits + (own & np.uint64(bits - 1)).astype(np.int64), minlength=len(n) * bits) & 1
            odd.append(np.packbits(slots.astype(np.uint8), bitorder="little").view(np.int64))
            first = last
        rare = lists(lengths, pa.array(np.concatenate(found).view(np.int64), mask=np.concatenate(single)))
        parity = lists([np.full(len(sizes), PARITY_WORDS)], pa.array(np.concatenate(odd)))
        return pa.StructArray.from_arrays([rare, parity], names=["rare", "parity"])

    return described


def shared_words(classes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(token, node, n, place, blocks): the rare words that several sets hold, and
    into how many blocks of sets those of a word are dealt. Of equal hashes of words
    or keys that differ, the check of the whole sets knows nothing."""
    rare = (classes.select(*keys, "node", "n", F.posexplode("rare").alias("place", "word")).filter("word IS NOT NULL")
            .select(F.xxhash64(*keys, "word").alias("token"), "node", "n", "place"))
    held = rare.withColumn("_held", F.count("*").over(Window.partitionBy("token"))).filter("_held > 1")
    return held.withColumn("blocks", F.ceil(F.col("_held") / BLOCK).cast("int")).drop("_held")


def pairs_sharing(shared: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: nodes that hold a rare word in common and whose sizes, and the
    words behind it in either, leave room for a link. The blocks of a word meet in
    pairs, each in a task of its own, so that no word is a single task's."""
    dealt = (shared.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("_met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("own", "_met"), "high": F.greatest("own", "_met")}))
    place = ["token", "low", "high"]
    # Both sides are the same rows in the same columns, which are shuffled once.
    one = dealt.select(*place, "own", F.col("node").alias("a"), "n", "place")
    other = dealt.select(*place, F.col("own").alias("own2"), F.col("node").alias("b"), F.col("n").alias("n2"), F.col("place").alias("place2"))
    once = F.when(F.col("low") == F.col("high"), F.col("a") < F.col("b")).otherwise(F.col("own") < F.col("own2"))
    possible = F.least("n", "n2").cast("double") / F.greatest("n", "n2") >= threshold
    behind = F.least(F.col("n") - F.col("place"), F.col("n2") - F.col("place2")) >= least_shared(F.col("n") + F.col("n2"), threshold)
    return (one.join(other, place).filter(once & possible & behind)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())


def asked_for(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` without most of those whose ``keys`` the stored ``wanted`` has not: a
    bitmap of a fixed number of slots goes to every task, so that the others stay
    where they lie. The bitmap gets coarser as ``wanted`` grows and drops no wanted row."""
    slot = F.shiftrightunsigned(F.xxhash64(*keys), 64 - ASKED_BITS).cast("int")
    bits = F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits")
    asked = written(wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("block")).agg(bits), "sets-asked")
    hit = (F.shiftright("slot", 6) == F.col("block")) & (F.getbit("bits", F.col("slot").bitwiseAND(63)) == 1)
    return rows.withColumn("slot", slot).join(asked, hit, "left_semi").drop("slot")


def alike_pairs(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """Those of the stored ``pairs`` (a, b) whose ``words`` (node, words) are
    ``threshold`` alike. Pairs gather in cells by the least node around, so that of
    sets which are all alike each moves once; a cell of many sets is dealt into blocks
    that meet in pairs, and the sets of two blocks are what a task holds at once."""
    around = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("least"))
    ends = [around.select(F.col("a").alias(end), F.least("a", "least").alias(f"cell_{end}")) for end in "ab"]
    celled = written(pairs.join(ends[0], "a").join(ends[1], "b").select(F.least("cell_a", "cell_b").alias("cell"), "a", "b"), "pairs-in-cells")
    sizes = (celled.select("cell", F.explode(F.array("a", "b")).alias("node")).distinct()
             .groupBy("cell").agg(F.ceil(F.count("*") / CELL).cast("int").alias("blocks")))
    blocks = [F.pmod(F.xxhash64(end), "blocks") for end in "ab"]
    cell = ["cell", "low", "high"]
    placed = written(celled.join(sizes, "cell").select("cell", F.least(*blocks).alias("low"), F.greatest(*blocks).alias("high"), "a", "b"), "pairs-in-blocks")
    # Words travel as text, which is a fraction of an array, and are arrays again once a cell.
    members = placed.select(*cell, F.explode(F.array("a", "b")).alias("node")).distinct().join(words.select("node", F.to_json("words").alias("text")), "node")
    back = F.transform(F.collect_list(F.struct("node", "text")), lambda e: F.struct(e["node"], F.from_json(e["text"], words.schema["words"].dataType)))
    held = members.groupBy(*cell).agg(F.map_from_entries(back).alias("held"))
    asked = placed.groupBy(*cell).agg(F.collect_list(F.struct("a", "b")).alias("asked"))
    found = F.filter("asked", lambda p: jaccard(F.col("held")[p["a"]], F.col("held")[p["b"]]) >= threshold)
    return held.join(asked, cell).select(F.explode(found).alias("pair")).select("pair.*")


def band_links(sets: DataFrame, keys: Sequence[str], threshold: float = NEAR) -> DataFrame:
    """``near_links`` of a stored table (keys, set_id, words, n), in which a set may
    stand several times. What finds pairs moves without words; the pairs that sizes
    and parities leave are looked up, a set with copies as one row.
    """
    if not threshold > 0:
        raise ValueError("any two sets are 0 alike: the threshold must be above 0")
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, "set_id", "words")])
    hashed = sets.filter(known).select(*keys, "set_id", "n", F.transform("words", lambda w: F.xxhash64(w)).alias("tokens"))
    described = rare_words(word_levels(hashed.select(F.explode("tokens").alias("token"))), threshold)
    classes = written(hashed.select(*keys, "set_id", "n", described("tokens").alias("_")).dropDuplicates([*keys, "set_id"])
                      .select(*keys, "set_id", "n", "_.*", F.monotonically_increasing_id().alias("node")), "scenario-classes")
    pairs = written(pairs_sharing(written(shared_words(classes, keys), "shared-words"), threshold), "pairs-sharing")

    # Sets differ in at least as many words as their parities do.
    own = classes.select(*keys, F.col("node").alias("a"), "n", "parity")
    other = classes.select(*keys, F.col("node").alias("b"), F.col("n").alias("n2"), F.col("parity").alias("parity2"))
    apart = F.aggregate(F.zip_with("parity", "parity2", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda all_, one: all_ + one)
    total = F.col("n") + F.col("n2")
    met = written(pairs.join(own, "a").join(other, ["b", *keys]).filter(apart <= total - 2 * least_shared(total, threshold)).select("a", "b"), "near-candidates")
    wanted = written(classes.join(met.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").select("node", *keys, "set_id"), "sets-to-compare")
    words = written(asked_for(sets.select(*keys, "set_id", "words"), wanted, [*keys, "set_id"]).join(wanted, [*keys, "set_id"])
                    .groupBy("node", *keys, "set_id").agg(F.first("words").alias("words")), "candidate-words")
    links = alike_pairs(met, words.select("node", "words"), threshold)
    one, two = (words.select(F.col("node").alias(end), *keys, F.col("set_id").alias(f"set_{end}")) for end in "ab")
    return (links.join(one, "a").join(two.drop(*keys), "b")
            .select(*keys, F.greatest("set_a", "set_b").alias("set_id"), F.least("set_a", "set_b").alias("earlier")))


def near_links(classes: DataFrame, keys: Sequence[str], threshold: float = NEAR) -> DataFrame:
    """(keys, set_id, earlier): all pairs of word sets that are at least ``threshold``
    alike, the smaller id as ``earlier``, from ``classes(keys, set_id, words)`` with
    one row per distinct set. Empty sets have no links.

    Of the words in order of rarity, sets that are alike share one among their first
    (prefix filter: a fifth of the words at 0.8); sets that do are candidates and are
    compared exactly, so no pair is left out. Where many sets are alike, their pairs
    are the result and grow with the square of the sets.
    """
    return band_links(written(classes.select(*keys, "set_id", "words", F.size("words").alias("n")), "scenario-sets"), keys, threshold)


def validation_diversity(rows: DataFrame, key: str = "dataset_id", threshold: float = NEAR) -> DataFrame:
    """Distinct share, family entropy (bits) and near-duplicate share.

    A near-duplicate repeats the word set of another row, or its word set is at
    least ``threshold`` alike (Jaccard) to any that stands before it in order of
    hash. Texts are reduced to their distinct word sets and hashes first and
    written once, where they lie; counting and finding candidates then move no
    words, and copies are counted and never paired.
    """
    words = (rows.select(key, normal_text(F.col("text")).alias("normal"))
             .select(key, F.sha2("normal", 256).alias("exact"), word_array(F.col("normal")).alias("words"))
             .withColumn("set_id", F.sha2(F.array_join("words", " "), 256)))
    sets = written(words.withColumn("n", F.size("words")), "scenario-sets")
    # Two grains in one shuffle each: (set, exact text) within the key, then the key.
    classes = (sets.groupBy(key, "set_id", "exact").agg(F.count("*").alias("n"))
               .groupBy(key, "set_id").agg(F.sum("n").alias("n"), F.count("*").alias("exact")))
    near = band_links(sets, [key], threshold).groupBy(key, "set_id").agg(F.lit(1).alias("near"))
    linked = near.groupBy(key).agg(F.count("*").alias("linked_sets"))
    texts = classes.groupBy(key).agg(F.sum("n").alias("scenarios"), F.sum("exact").alias("distinct_texts"), F.count("*").alias("distinct_sets"))
    share = _mix(rows, [key], "task_family", "p")
    entropy = share.groupBy(key).agg((-F.sum(F.col("p") * F.log2("p"))).alias("family_entropy"))
    repeats = F.col("scenarios") - F.col("distinct_sets") + F.coalesce("linked_sets", F.lit(0))
    return texts.join(entropy, key).join(linked, key, "left").select(
        key, "scenarios", (F.col("distinct_texts").cast("double") / F.col("scenarios")).alias("distinct_share"),
        "family_entropy", (repeats.cast("double") / F.col("scenarios")).alias("near_duplicate_share"))


def validation_verdict(report: DataFrame, min_validity: float = 0.9, max_distance: float = 0.25,
                       min_distinct: float = 0.8) -> DataFrame:
    """Advisory ``pass`` or ``warn`` from the three reports joined per dataset;
    a missing figure warns."""
    good = ((F.col("validity") >= min_validity) & (F.col("total_variation") <= max_distance)
            & (F.col("distinct_share") >= min_distinct))
    return report.withColumn("verdict", F.when(good, "pass").otherwise("warn"))


def mark_duplicate_scenarios(rows: DataFrame) -> DataFrame:
    """Flag every later copy of a scenario text within its representation; rows
    are all kept. Texts are normalised once: ids and hashes are written, the first
    copy is a partial aggregate over them, and only later copies, if there are
    any, are looked up for the rows."""
    place = ["representation_id", "scenario_id", "_text"]
    hashed = written(rows.select(*place[:2], F.xxhash64("text").alias("_text"), F.sha2(normal_text(F.col("text")), 256).alias("_hash")), "scenario-hashes")
    copies = ["representation_id", "_hash"]
    firsts = hashed.groupBy(*copies).agg(F.min("scenario_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    later = hashed.join(firsts, copies).filter("scenario_id > _first").select(*place).distinct().withColumn("_later", F.lit(True))
    return (rows.withColumn("_text", F.xxhash64("text")).join(later, place, "left")
            .select(*rows.columns, F.coalesce("_later", F.lit(False)).alias("is_duplicate")))


def calibration_weights(rows: DataFrame) -> DataFrame:
    """Sampling weight per family from verdicts: p(1-p) with p smoothed as
    (passed + 1) / (judged + 2), normalised within a check set ``scope``."""
    stats = rows.groupBy("scope", "task_family").agg(
        F.count("verdict").alias("judged"), F.count_if("verdict").alias("passed"))
    p = (F.col("passed") + 1.0) / (F.col("judged") + 2.0)
    # One row per family: the window sees counts, not rows.
    return (stats.withColumn("raw", p * (1 - p))
            .withColumn("weight", F.col("raw") / F.sum("raw").over(Window.partitionBy("scope")))
            .drop("raw"))


def family_quotas(pool: DataFrame, weights: DataFrame, count: int) -> DataFrame:
    """How many of ``count`` rows each family gets: largest remainder on the
    weights, never more than the family has. A family without a weight weighs 0
    and is drawn from only where the others do not suffice."""
    sizes = pool.groupBy("task_family").agg(F.count("*").alias("size"))
    shares = (sizes.join(weights, "task_family", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
              .withColumn("scope", F.lit(0)))
    whole = Window.partitionBy("scope")  # one row per family
    exact = F.coalesce(F.lit(float(count)) * F.col("weight") / F.nullif(F.sum("weight").over(whole), F.lit(0.0)), F.lit(0.0))
    parts = shares.withColumn("exact", exact).withColumn("base", F.floor("exact"))
    rank = F.row_number().over(whole.orderBy(F.desc(F.col("exact") - F.col("base")), "task_family"))
    left = F.lit(count) - F.sum("base").over(whole)
    wanted = parts.withColumn("wanted", F.col("base") + F.when(rank <= left, 1).otherwise(0))
    # Families smaller than their quota pass the rest on, largest stock first.
    capped = wanted.withColumns({"quota": F.least("wanted", "size"),
                                 "spare": F.greatest(F.lit(0), F.col("size") - F.col("wanted"))})
    missing = F.lit(count) - F.sum("quota").over(whole)
    before = F.coalesce(F.sum("spare").over(
        whole.orderBy(F.desc("spare"), "task_family").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    extra = F.greatest(F.lit(0), F.least(F.col("spare"), missing - before))
    return capped.select("task_family", (F.col("quota") + extra).cast("bigint").alias("quota"))


def hash_order(scenario_id: Column, seed: int) -> Column:
    """Deterministic shuffling key in 0 .. 2**40 - 1 from SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), scenario_id.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 10), 16, 10).cast("bigint")


def sample_scenarios(pool: DataFrame, weights: DataFrame, count: int, seed: int) -> DataFrame:
    """Exactly ``count`` scenarios (or the whole pool), stratified by family and
    the same for the same seed. Each task keeps at most ``count`` rows of a family
    before the shuffle (window group limit)."""
    keyed = pool.withColumn("_key", hash_order(F.col("scenario_id"), seed))
    order = Window.partitionBy("task_family").orderBy("_key", "scenario_id")
    ranked = keyed.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= count)
    return (ranked.join(family_quotas(pool, weights, count), "task_family")
            .filter(F.col("_rank") <= F.col("quota")).drop("_key", "_rank", "quota"))
