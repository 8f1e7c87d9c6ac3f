"""N-gram Jaccard join: classes of equal sets, candidate clusters, signature trees.

Documents with equal shingle sets are one class. Classes that could be similar
must share a shingle among their rarest ones (prefix filter). Of the classes that
share one, each is first compared with the least; then those that are still apart
are compared in pairs, where few share the shingle. Where many do, they make
clusters; inside a cluster a tree over token bitmaps is traversed against
itself: nodes hold the OR of their members' bitmaps and their size range, and a
pair of nodes is dropped when the largest overlap possible is too small. Pairs
outside trees are held against each other as parity bitmaps first. Pairs
that stay are checked on the whole sets. Only links between different sets are
looked for, and none is when both sides are connected already. Texts move once,
and only those that a check can ask for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdictlake.llm.common import BATCH_BYTES, arrow_batches, boxed, table, unboxed, written
from verdictlake.llm.components import components
from verdictlake.llm.shingles import SHINGLE_WORDS, digest, mixed, shingle_set
from verdictlake.operators.ordered import number_block, positions

PERCENT = 80
SKETCH_BITS = 20
BIN_TOKENS = 1 << 19
CLUSTER_PART = 4096
SIGNATURE_BYTES = 1024
LEAF = 32
STRETCH_PAIRS = 400_000
STRETCH_SLOTS = 1 << 16
FEW = 256
MET_AT_ONCE = 256

WANTED_BITS = 24

SETS = "doc_id long, n int, digest binary, mark long, parity binary, slots int, counts binary"
ENTRY = np.dtype([("token", "<i8"), ("key", "<i8"), ("n", "<i4")])


def least_overlap(a, b, percent: int = PERCENT):
    """The smallest intersection with which sets of these sizes are linked."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """So many rarest tokens: linked sets share one of them, for an intersection
    with a linked set is at least ``percent`` of ``n``."""
    return n - -(-percent * n // 100) + 1


# ---- parity bitmaps

def parity(tokens: np.ndarray) -> bytes:
    """A bitmap of about as many bits as the set has tokens: which slots hold an
    odd number of them."""
    width = 1 << max(6, (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(one: bytes, other: bytes) -> int:
    """Two sets differ in at least as many tokens as their bitmaps, the wider one
    folded, differ in bits."""
    if len(one) < len(other):
        one, other = other, one
    a, b, bits = int.from_bytes(one, "little"), int.from_bytes(other, "little"), 4 * len(one)
    while bits >= 8 * len(other):
        a = (a >> bits) ^ (a & ((1 << bits) - 1))
        bits //= 2
    return (a ^ b).bit_count()


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of class keys whose bitmaps do not rule a link out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [least_difference(one, other) <= n + n2 - 2 * least_overlap(n, n2, percent)
                    for n, n2, one, other in zip(*[c.to_pylist() for c in batch.columns[2:]])]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    own = classes.select(F.col("node").alias("a"), "n", F.col("parity").alias("one"))
    other = classes.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("parity").alias("other"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "n", "n2", "one", "other").mapInArrow(run, "a long, b long")


# ---- sets and the sketch of token frequencies

def described_sets(docs: DataFrame, words: int, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """A row per document (n, digest and parity of its set, mark of its text) and, from each task, rows (slots,
    counts): for a stretch of slots, packed, how often its sets hold a token whose
    hash falls into each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, names = np.zeros(1 << sketch_bits, np.int64), ["doc_id", "n", "digest", "mark", "parity", "slots", "counts"]
        for batch in batches:
            sizes, digests, bitmaps = [], [], []
            for text in batch.column(1):
                tokens = shingle_set(text.as_py(), words)
                np.add.at(counts, (tokens >> np.uint64(64 - sketch_bits)).astype(np.int64), 1)
                sizes.append(len(tokens)), digests.append(digest(tokens)), bitmaps.append(parity(tokens))
            gap = pa.nulls(len(sizes), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                                              batch.column(2), pa.array(bitmaps, pa.binary()), gap, pa.nulls(len(sizes), pa.binary())], names)
        for first in range(0, len(counts), STRETCH_SLOTS):
            own = counts[first:first + STRETCH_SLOTS]
            if own.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([first], pa.int32()),
                                                  pa.array([zlib.compress(own.astype("<i8").tobytes(), 1)], pa.binary())], names)

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, SETS)


def sketch_of(described: DataFrame, sketch_bits: int = SKETCH_BITS) -> np.ndarray:
    """Counts by slot: 2**sketch_bits numbers, whatever the size of the corpus.
    They only order tokens (rare ones first); any order gives the same links."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(zlib.decompress(packed.as_py()), "<i8")
                sums[first] = sums[first] + own if first in sums else own
        for first, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int32()), pa.array([own.astype("<i8").tobytes()], pa.binary())], ["slots", "counts"])

    counts = np.zeros(1 << sketch_bits, np.int64)
    stretches = -(-len(counts) // STRETCH_SLOTS)
    packed = described.filter("slots IS NOT NULL").select("slots", "counts")
    for r in packed.repartition(stretches, "slots").mapInArrow(add, "slots int, counts binary").collect():
        own = np.frombuffer(r.counts, "<i8")
        counts[r.slots:r.slots + len(own)] += own
    return counts


# ---- candidates

def class_key(found: bytes) -> int:
    """The first 64 bits of a digest; equal keys of different sets only make them
    candidates of the same others."""
    return int.from_bytes(found[:8], "big", signed=True)


def sharing(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``ENTRY`` rows, once each, those whose token others have too, and for
    each the smallest class with the token (by size, then key) and how many have it."""
    found = found[np.lexsort((found["key"], found["n"], found["token"]))]
    again = (found["token"][1:] == found["token"][:-1]) & (found["key"][1:] == found["key"][:-1])
    found = found[np.append(True, ~again)]
    first = np.flatnonzero(np.append(True, found["token"][1:] != found["token"][:-1]))
    sizes = np.diff(np.append(first, len(found)))
    hub = np.repeat(first, sizes)
    totals = np.repeat(sizes, sizes)
    kept = totals > 1
    return found[kept], found[hub][kept], totals[kept].astype(np.int64)


def shared_prefixes(docs: DataFrame, counts: np.ndarray, bins: int, words: int, percent: int) -> DataFrame:
    """(token, key, n, hub, hub_n, total): the classes that share a token of their
    prefixes with others, the smallest of them, and how many they are.

    Tokens travel packed, in one binary row per bin of token hashes and stretch
    of input; those that one class alone has go no further.
    """
    bits = (bins - 1).bit_length()
    shift = np.uint64(64 - (len(counts) - 1).bit_length())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        load = 0

        def close() -> pa.RecordBatch:
            """Entries are sorted by bin once; the rows are slices of that buffer."""
            found = np.concatenate(held)
            held.clear()
            place = (mixed(found["token"].view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            used, starts = np.unique(place[order], return_index=True)
            ends = (np.append(starts, len(found)) * ENTRY.itemsize).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(ends), pa.py_buffer(found[order].view(np.uint8))])
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), packed], ["bin", "entries"])

        for batch in batches:
            for text in batch.column(0):
                tokens = shingle_set(text.as_py(), words)
                if not len(tokens):
                    continue
                key = class_key(digest(tokens))
                if key in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                length = prefix_length(len(tokens), percent)
                rank = counts[(tokens >> shift).astype(np.int64)]
                own = np.empty(length, ENTRY)
                own["token"] = tokens[np.lexsort((tokens, rank))[:length]].view(np.int64)
                own["key"], own["n"] = key, len(tokens)
                held.append(own)
                load += length
                if load > STRETCH_PAIRS:
                    yield close()
                    load = 0
        if held:
            yield close()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bins arrive whole, one after the other."""
        def rows(parts: list[bytes]) -> pa.RecordBatch:
            found, hub, total = sharing(np.frombuffer(b"".join(parts), ENTRY))
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (found["token"], found["key"], found["n"], hub["key"], hub["n"], total)],
                                              ["token", "key", "n", "hub", "hub_n", "total"])

        current, parts = None, []
        for batch in batches:
            for number, entries in zip(*[c.to_pylist() for c in batch.columns]):
                if number != current and parts:
                    yield rows(parts)
                    parts = []
                current = number
                parts.append(entries)
        if parts:
            yield rows(parts)

    return (docs.select("text").mapInArrow(cut, "bin int, entries binary")
            .repartition("bin").sortWithinPartitions("bin")
            .mapInArrow(gather, "token long, key long, n int, hub long, hub_n int, total long"))


def still_apart(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Entries of ``shared`` whose token is met in several components (node,
    component), with their ``component``. Of two classes that share a token one is
    its hub, so their entries stay behind."""
    placed = (shared.filter("total > 2").drop("hub_n").join(joined.withColumnRenamed("node", "key"), "key", "left")
              .withColumn("component", F.coalesce("component", "key")))
    spread = (placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
              .filter("low < high").select("token"))
    return placed.join(spread, "token")


def pairs_apart(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): classes of different components that share a token, the smaller
    one first; pairs with a token's hub were met before."""
    rest = entries.filter("key <> hub").select("token", "key", "n", "component")
    other = rest.select("token", F.col("key").alias("b"), F.col("n").alias("n2"), F.col("component").alias("component2"))
    return (rest.withColumnRenamed("key", "a").join(other, "token")
            .filter(f"component <> component2 AND (n < n2 OR n = n2 AND a < b) AND 100 * n >= {percent} * n2").select("a", "b").distinct())


# ---- texts that are asked for

def wanted_slots(wanted: DataFrame) -> DataFrame:
    """(word, bits): into which slots rows of ``wanted`` (slot) fall, 64 slots to a
    word; at most one row per 64 slots, whatever the size of the corpus."""
    return wanted.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits"))


def texts_of(nodes: DataFrame, classes: DataFrame, marked: DataFrame, bits: int = WANTED_BITS) -> DataFrame:
    """(node, text) of the class keys ``nodes``. Texts that fall into no slot of a
    wanted one stay where they lie; the join drops those that share one by chance.
    The slots go to every task, so that no text moves, nor leaves the JVM, to meet them."""
    def slotted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("slot", F.shiftrightunsigned(F.xxhash64("class", "mark"), 64 - bits))

    wanted = written(slotted(nodes.distinct().join(classes.select("node", "class", "mark"), "node")), "classes-to-check")
    asked = (F.shiftright("slot", 6) == F.col("word")) & (F.getbit("bits", F.col("slot").bitwiseAND(63).cast("int")) == 1)
    found = slotted(marked).join(F.broadcast(wanted_slots(wanted)), asked, "left_semi").select("class", "mark", "text")
    return written(found.join(wanted.drop("slot"), ["class", "mark"]).select("node", "text"), "texts-to-check")


# ---- pairs on whole sets

def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are linked."""
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= least_overlap(len(a), len(b), percent)


def pair_links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of class keys that are linked. The texts of all ``b`` of
    an ``a`` stream behind its own; of an ``a`` with very many, in several slices."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MET_AT_ONCE).alias("slices"))
    dealt = pairs.join(counts, "a").select("a", "b", F.expr("cast(pmod(xxhash64(b), slices) AS int)").alias("slice"))
    rows = dealt.unionByName(dealt.select("a", F.col("a").alias("b"), "slice").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            found = [[], []]
            for a, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if a == b:
                    if a != hub:
                        hub, own = a, shingle_set(text.as_py(), words)
                elif a == hub and linked(own, shingle_set(text.as_py(), words), percent):
                    found[0].append(a), found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["a", "b"])

    return (rows.join(texts.select(F.col("node").alias("b"), "text"), "b").repartition("a", "slice")
            .sortWithinPartitions("a", "slice", F.col("a") != F.col("b")).select("a", "b", "text").mapInArrow(run, "a long, b long"))


# ---- signature trees

class SignatureTree:
    """Sets in leaves of ``LEAF``, as many nodes to a node; ``bits`` are OR-combined bitmaps,
    ``low``/``high`` the sizes and ``few`` the least number of bits of a member."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT, width: int = SIGNATURE_BYTES, joined: list[int] | None = None):
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))
        self.members, self.sets, self.percent = order, [sets[i] for i in order], percent
        bits = np.zeros((len(sets), width * 8), bool)
        for row, tokens in zip(bits, self.sets):
            row[(tokens % np.uint64(width * 8)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        self.size = np.array([len(s) for s in self.sets])
        self.root = np.arange(len(sets))
        if joined:  # which of them are connected already
            _, first, place = np.unique([joined[i] for i in order], return_index=True, return_inverse=True)
            self.root = first[place]
        few = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.few = few
        self.levels = []
        level = (self.bits, self.size, self.size, few, np.arange(len(sets)), np.arange(1, len(sets) + 1))
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), LEAF)
            level = (np.bitwise_or.reduceat(level[0], starts, axis=0), np.minimum.reduceat(level[1], starts),
                     np.maximum.reduceat(level[2], starts), np.minimum.reduceat(level[3], starts),
                     level[4][starts], np.append(level[4][starts[1:]], len(sets)))
            self.levels.append(level)

    def possible(self, common: int, low_a, high_a, few_a, low_b, high_b, few_b) -> bool:
        """Whether members of two nodes can be linked: a member misses as many
        tokens as it has bits outside the common ones, at least."""
        if 100 * high_a < self.percent * low_b or 100 * high_b < self.percent * low_a:
            return False
        most = min(high_a - max(0, few_a - common), high_b - max(0, few_b - common))
        return most >= least_overlap(low_a, low_b, self.percent)

    def joined(self) -> list[tuple[int, int]]:
        """Links that connect all linked sets: (item, item), as few as possible."""
        links: list[tuple[int, int]] = []
        stack = [(len(self.levels) - 1, 0, 0)] if self.levels else []
        while stack:
            level, a, b = stack.pop()
            bits, low, high, few, start, stop = self.levels[level]
            left, right = self.root[start[a]:stop[a]], self.root[start[b]:stop[b]]
            if left[0] == right[0] and (left == left[0]).all() and (right == right[0]).all():
                continue
            if a != b and not self.possible(int(np.bitwise_count(bits[a] & bits[b]).sum()), low[a], high[a], few[a],
                                            low[b], high[b], few[b]):
                continue
            if level:
                kids = [range(n * LEAF, min((n + 1) * LEAF, len(self.levels[level - 1][0]))) for n in (a, b)]
                pairs = [(level - 1, x, y) for x in kids[0] for y in kids[1] if x <= y]
                stack.extend(sorted(pairs, key=lambda p: p[1] - p[2]))  # near pairs are popped first
            else:
                self._leaves(start[a], stop[a], start[b], stop[b], links)
        return [(self.members[x], self.members[y]) for x, y in links]

    def _leaves(self, a: int, a_stop: int, b: int, b_stop: int, links: list) -> None:
        common = np.bitwise_count(self.bits[a:a_stop, None] & self.bits[None, b:b_stop]).sum(axis=2, dtype=np.int64)
        size_a, size_b = self.size[a:a_stop, None], self.size[None, b:b_stop]
        lost_a = np.maximum(0, self.few[a:a_stop, None] - common)
        lost_b = np.maximum(0, self.few[None, b:b_stop] - common)
        most = np.minimum(size_a - lost_a, size_b - lost_b)
        able = most >= least_overlap(size_a, size_b, self.percent)
        for x, y in zip(*np.nonzero(able)):
            x, y = x + a, y + b
            if x < y and self.root[x] != self.root[y] and linked(self.sets[x], self.sets[y], self.percent):
                links.append((int(x), int(y)))
                self.root[self.root == self.root[y]] = self.root[x]


def cluster_parts(classes: DataFrame, part: int, percent: int = PERCENT) -> DataFrame:
    """Add ``part``: clusters above ``part`` classes are cut along their sizes,
    and each class goes to every pair of parts whose sizes can match, once."""
    key = ["cluster"]
    totals = classes.groupBy(*key).agg(F.count(F.lit(1)).alias("total"))
    sized = classes.join(totals, key)
    small = sized.filter(F.col("total") <= part).withColumn("part", F.lit("0"))
    large = positions(sized.filter(F.col("total") > part), key, ["n", "class"], number_block("n", 4), "place")
    large = large.withColumn("own", F.floor(F.col("place") / part).cast("int"))
    ranges = large.groupBy("cluster", "own").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = ranges.select("cluster", F.col("own").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    met = (ranges.join(other, "cluster")
           .filter(f"{percent} * low <= 100 * high2 AND {percent} * low2 <= 100 * high")
           .select("cluster", "own", F.concat_ws("-", F.least("own", "other"), F.greatest("own", "other")).alias("part")))
    return small.select(*classes.columns, "part").unionByName(large.join(met, ["cluster", "own"]).select(*classes.columns, "part"))


def cluster_links(members: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links between class keys, from one tree per (cluster, part)."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node").sort_values("node")
        sets = [shingle_set(t, words) for t in rows["text"]]
        links = SignatureTree(sets, percent, joined=rows["joined"].tolist()).joined() if len(sets) > 1 else []
        ids = rows["node"].to_numpy()
        return pd.DataFrame({"a": [int(ids[x]) for x, _ in links], "b": [int(ids[y]) for _, y in links]}, dtype="int64")

    return members.groupBy("cluster", "part").applyInPandas(run, "a long, b long")


def jaccard_components(docs: DataFrame, *, words: int = SHINGLE_WORDS, percent: int = PERCENT,
                       part: int = CLUSTER_PART, few: int = FEW) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Two documents link when ``100 * |A n B| >= percent * |A u B|`` over their sets
    of word shingles; the component is the least doc_id reached by links.

    A null text, or one without words, has the empty set and links with nothing.
    Equal sets link. A null doc_id is kept, with its size and a null component.
    Rows that repeat a doc_id are rows of their own and may lie in different
    components. An empty table gives no rows; other columns are not read.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        bare = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        described = written(described_sets(bare, words), "shingle-sets")
        counts = sketch_of(described)
        rows = described.filter("slots IS NULL").select("doc_id", "n", "digest", "mark", "parity")
        least = F.min(F.struct("doc_id", "mark"))
        classes = written(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(least.alias("least"), F.first("n").alias("n"), F.first("parity").alias("parity"))
                          .select("digest", F.col("least.doc_id").alias("class"), F.col("least.mark").alias("mark"), "n", "parity",
                                  F.expr("cast(conv(hex(substring(digest, 1, 8)), 16, -10) AS long)").alias("node")),
                          "shingle-classes")
        tokens = classes.agg(F.sum("n")).first()[0] or 0
        bins = 1 << max(4, (int(tokens) // BIN_TOKENS).bit_length())
        shared = written(shared_prefixes(bare, counts, bins, words, percent), "shared-prefixes")
        marked = bare.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("class"), F.xxhash64("text").alias("mark"), "text")

        near = shared.filter(f"key <> hub AND 100 * hub_n >= {percent} * n").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
        near = written(near, "hub-pairs")
        likely = written(likely_pairs(near, classes, percent), "likely-hub-pairs")

        # All that checks can ask for: classes of likely pairs, and, as if those were
        # linked, of pairs and trees across what is then still apart. Components of the
        # real links are parts of these, so what they leave apart is among the same.
        open_ = written(still_apart(shared, components(likely, "likely-components")), "likely-apart")
        across = likely_pairs(pairs_apart(open_.filter(F.col("total") <= few), percent), classes, percent)
        ends = likely.unionByName(across).select(F.explode(F.array("a", "b")).alias("node"))
        texts = texts_of(ends.unionByName(open_.filter(F.col("total") > few).select(F.col("key").alias("node"))), classes, marked)

        links = written(pair_links(likely, texts, words, percent), "hub-links")
        apart = written(still_apart(shared, components(links, "hub-components")), "still-apart")

        pairs = pairs_apart(apart.filter(F.col("total") <= few), percent).join(near, ["a", "b"], "left_anti")
        pairs = written(likely_pairs(pairs, classes, percent), "pairs-apart")
        links = links.unionByName(pair_links(pairs, texts, words, percent))

        many = apart.filter(F.col("total") > few)
        clusters = components(many.filter("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")), "candidate-clusters")
        inside = (many.groupBy(F.col("key").alias("node")).agg(F.first("component").alias("joined"))
                  .join(clusters.withColumnRenamed("component", "cluster"), "node").join(classes.select("node", "class", "n"), "node"))
        members = written(cluster_parts(inside, part, percent), "cluster-members").join(texts, "node")
        links = links.unionByName(cluster_links(members, words, percent))
        named = [classes.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in "ab"]
        links = components(links.join(named[0], "a").join(named[1], "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b")), "links")

        own = classes.select("digest", "class").join(links.withColumnRenamed("node", "class"), "class", "left").select(
            "digest", F.coalesce("component", "class").alias("component"))
        return rows.join(own, "digest", "left").select(
            "doc_id", F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents with the least doc_id of each component, whole and in all
    their columns.

    Rows with one doc_id are one document, which goes if any of its texts is
    linked to a smaller one; of rows with equal id and text one stays. Texts
    without words (null and empty ones) and rows without doc_id stay; texts of any
    length are compared whole; an empty table stays empty. All columns stay as
    they are, whatever their names.
    """
    gone = jaccard_components(docs.select("doc_id", "text"), **options).filter("component_id < doc_id").select("doc_id").distinct()
    kept = boxed(docs, "doc_id", "text").join(written(gone, "near-duplicates"), "doc_id", "left_anti")
    one = Window.partitionBy("doc_id", F.md5(F.col("text").cast("binary"))).orderBy(F.lit(0))
    once = kept.filter("doc_id IS NOT NULL").withColumn("place", F.row_number().over(one)).filter("place = 1").select("_whole")
    return unboxed(once.unionByName(kept.filter("doc_id IS NULL").select("_whole")), docs.columns)


def op5_jaccard_components(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: five words, 80 percent."""
    return jaccard_components(table(spark, sf_dir, "documents"))
