"""Ranked lexical search with exact integer scores, by buckets of vector length.

A document's impact vector holds, per query term, what one unit of the term's
weight earns there; a score is its inner product with the item's weights. Inside
a task the vectors are ordered by length and cut into buckets. With an item's
tenth best score known so far, a bucket is left out whole if even its longest
vector cannot reach it (Cauchy-Schwarz, or the bucket's largest coordinates).
Inside a bucket the item's focus coordinates are added up exactly, what is left is
bounded by the coordinates' largest values and by the rest of both lengths, and
only the survivors are scored in full, in 64-bit integers (Teflioudi et al. 2015).
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdictlake.llm.common import table, written
from verdictlake.llm.tokens import byte_slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
BUCKET = 2048
BLOCK_ROWS = 65_536
BLOCK_IMPACTS = 8_000_000
BLOCK_TERMS = 200_000
SEEDS = 512
LOST = 1 << 62

_KEPT = string.digits + string.ascii_letters
# Bytes of a text to bytes of its terms: A-Z become a-z, other ASCII that is no
# letter or digit becomes a space, bytes above 127 stay.
_TERM_BYTES = bytes(ord(chr(b).lower()) if chr(b) in _KEPT else b if b > 127 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class Items(NamedTuple):
    """A block of items: ids, and their terms' numbers in CSR form; ``vocabulary``
    numbers the terms of the block."""
    ids: list
    starts: np.ndarray
    terms: np.ndarray
    vocabulary: dict[bytes, int]


def item_terms(items: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(block, item_id, terms): each item's distinct terms; rows of one item_id
    are one item. Items are dealt by a hash into blocks of about ``block_terms``
    terms, which bounds what is sent to tasks at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t or ""))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select("item_id", "text").mapInArrow(run, "item_id long, terms array<binary>")
    each = written(rows.select("item_id", F.explode("terms").alias("term")).groupBy("item_id")
                   .agg(F.collect_set("term").alias("terms")), "items")
    total = each.agg(F.sum(F.size("terms"))).first()[0] or 0
    return each.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(-(-total // block_terms) or 1)))


def item_block(rows: list) -> Items:
    rows = sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0))
    vocabulary: dict[bytes, int] = {}
    terms = [[vocabulary.setdefault(bytes(t), len(vocabulary)) for t in sorted(r.terms)] for r in rows]
    return Items([r.item_id for r in rows], np.cumsum([0, *map(len, terms)]),
                 np.array([t for own in terms for t in own], np.int64), vocabulary)


def term_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs, reach): a row per document with a term, whole texts:
    all its terms counted in ``n``, the vocabulary's terms listed with their
    counts; ``reach`` grows with the length of its vector (squared, at mean size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            for part in byte_slices(batch, 1):
                names, sizes, terms, counts, reach = [], [], [], [], []
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if found := terms_of(text or ""):
                        own = np.array([t for t in map(number, found) if t is not None], np.int64)
                        distinct, tf = np.unique(own, return_counts=True)
                        names.append(name), sizes.append(len(found)), terms.append(distinct), counts.append(tf)
                        reach.append(float(((tf / (tf + 0.8)) ** 2).sum()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())),
                     pa.array(reach, pa.float64())], ["doc_id", "n", "terms", "tfs", "reach"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>, reach double")


def collection_counts(rows: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(N, L, df by term number): each task adds up its own documents first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            total[size] += batch.num_rows
            total[size + 1] += sum(batch.column(0).to_pylist())
            terms = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            total[:size] += np.bincount(terms, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["term", "df"])

    out = np.zeros(size + 2, np.int64)
    for r in rows.select("n", "terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df
    return int(out[size]), int(out[size + 1]), out[:size]


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    """A term's weight from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What one unit of weight earns, by the term's count and the document's size."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        n = n.astype(object)
    norm = (10 + (90 * n * documents) // max(length, 1)).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)


class Bucket:
    """Vectors of similar length: documents in CSC form with their lengths."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, value: np.ndarray, lengths: np.ndarray, size: int):
        order = np.argsort(term, kind="stable")
        self.owner, self.value = owner[order], value[order]
        self.starts = np.searchsorted(term[order], np.arange(size + 1))
        self.lengths, self.longest = lengths, float(lengths.max())
        self.largest = np.zeros(size, np.int64)
        if len(term):
            used = np.flatnonzero(np.diff(self.starts))
            self.largest[used] = np.maximum.reduceat(self.value, self.starts[used])

    def rows(self, terms: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, value, weight) of all entries of some terms."""
        parts = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (np.concatenate([self.owner[p] for p in parts]), np.concatenate([self.value[p] for p in parts]),
                np.repeat(weight, [p.stop - p.start for p in parts]))

    def search(self, terms: np.ndarray, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) of all documents whose score is ``least`` or more, of
        an item's terms by descending weight. Bounds are doubles, widened by more
        than they can err; scores are integers."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        reach = weight * self.largest[terms]
        if least > reach.sum() or least > math.sqrt(float((weight.astype(float) ** 2).sum())) * self.longest * (1 + 1e-9):
            return none
        # The fewest first coordinates after which the others alone cannot reach it.
        rest = np.cumsum(reach[::-1])[::-1]
        focus = int(np.searchsorted(-rest, -least, side="right")) if least > 0 else len(terms)
        focus = max(1, focus)
        owner, value, by = self.rows(terms[:focus], weight[:focus])
        partial = np.bincount(owner, (value * by).astype(float), len(self.lengths))
        held = np.bincount(owner, value.astype(float) ** 2, len(self.lengths))
        left = math.sqrt(float((weight[focus:].astype(float) ** 2).sum()))
        beyond = np.minimum(left * np.sqrt(np.maximum(self.lengths ** 2 - held, 0) + 1e-6 * self.lengths ** 2),
                            float(rest[focus]) if focus < len(terms) else 0.0)
        alive = (partial + beyond) * (1 + 1e-9) + 1 >= least
        if least <= 0:
            alive &= held > 0
        kept = np.flatnonzero(alive)
        if not len(kept):
            return none
        owner, value, by = self.rows(terms, weight)
        mine = alive[owner]
        scores = np.zeros(len(self.lengths), np.int64)
        np.add.at(scores, owner[mine], value[mine] * by[mine])
        kept = kept[(scores[kept] >= least) & (scores[kept] > 0)]
        return kept, scores[kept]


class Searcher:
    """Searches blocks of vectors for all items of a block, keeping each item's
    best (score descending, document id ascending, null ids last)."""

    def __init__(self, items: Items, weight: np.ndarray, least: np.ndarray, top: int):
        self.top, self.floor = top, least.copy()
        self.asked = []
        for a, b in zip(items.starts, items.starts[1:]):
            terms = items.terms[a:b]
            terms = terms[weight[terms] > 0]
            terms = terms[np.argsort(-weight[terms], kind="stable")]
            self.asked.append((terms, weight[terms]))
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.asked]
        self.size = len(weight)

    def block(self, names: np.ndarray, counts: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        """Search vectors given row by row: ids (``LOST``: null), entry counts, entries."""
        owner = np.repeat(np.arange(len(names)), counts)
        lengths = np.sqrt(np.bincount(owner, value.astype(float) ** 2, len(names)))
        order = np.argsort(-lengths, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        bucket_of = place[owner] // BUCKET
        by_bucket = np.argsort(bucket_of, kind="stable")
        cuts = np.searchsorted(bucket_of[by_bucket], np.arange(-(-len(names) // BUCKET) + 1))
        for n in range(len(cuts) - 1):
            mine = by_bucket[cuts[n]:cuts[n + 1]]
            docs = order[n * BUCKET:(n + 1) * BUCKET]
            bucket = Bucket(place[owner[mine]] - n * BUCKET, term[mine], value[mine], lengths[docs], self.size)
            for k, (terms, weight) in enumerate(self.asked):
                if len(terms):
                    found, scores = bucket.search(terms, weight, int(self.floor[k]))
                    if len(found):
                        self.keep(k, scores, names[docs[found]])

    def keep(self, k: int, scores: np.ndarray, names: np.ndarray) -> None:
        first = np.lexsort((names, -scores))[:self.top]
        best = sorted([*self.best[k], *((-int(s), int(d)) for s, d in zip(scores[first], names[first]))])[:self.top]
        self.best[k] = best
        if len(best) == self.top:
            self.floor[k] = max(self.floor[k], -best[-1][0])


def searched(rows: DataFrame, items: Items, weight: np.ndarray, documents: int, length: int, least: np.ndarray, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best of each task. A task holds one block of
    vectors at a time, bounded in rows and in entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, weight, least, top)
        held: list[tuple] = []

        def flush() -> None:
            if held:
                searcher.block(*(np.concatenate(c) for c in zip(*held)))
                held.clear()

        for whole in batches:
            for batch in (whole.slice(i, 8192) for i in range(0, whole.num_rows, 8192)):
                names = batch.column(0).fill_null(LOST).to_numpy(zero_copy_only=False)
                counts = batch.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
                value = impacts(tf, np.repeat(batch.column(1).to_numpy(zero_copy_only=False), counts), documents, length)
                held.append((names, counts, batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64), value))
                if sum(len(h[0]) for h in held) >= BLOCK_ROWS or sum(len(h[2]) for h in held) >= BLOCK_IMPACTS:
                    flush()
        flush()
        found = [(items.ids[k], None if d == LOST else d, -s) for k, best in enumerate(searcher.best) for s, d in best]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def seed_scores(rows: DataFrame, items: Items, weight: np.ndarray, documents: int, length: int, top: int, seeds: int = SEEDS) -> np.ndarray:
    """Each item's lowest place among a bounded number of long vectors: no score
    below it can be among the item's best of all documents."""
    first = rows.filter(F.size("terms") > 0).orderBy(F.desc("reach"), "doc_id").limit(seeds)
    floor = np.zeros(len(items.ids), np.int64)
    best: dict[int | None, list[int]] = {}
    for r in searched(first, items, weight, documents, length, floor, top).collect():
        best.setdefault(r.item_id, []).append(r.score)
    for k, name in enumerate(items.ids):
        if len(scores := best.get(name, [])) >= top:
            floor[k] = sorted(scores, reverse=True)[top - 1]
    return floor


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` best documents.

    All rows of ``docs`` are read whole; a row is a document, also where ids
    repeat, and equal scores go by ascending doc_id, null ids last. Null texts and
    texts without terms take no part, items without terms or hits give no rows;
    rows of one item_id (null ids too) make one item of all their terms. Texts and
    terms of any length count; empty tables give no rows; other columns are not
    read. Items are searched in blocks of a bounded number of terms, each block
    against all documents.
    """
    spark = docs.sparkSession
    asked = item_terms(items, block_terms)
    out = None
    for (block,) in sorted(tuple(r) for r in asked.select("block").distinct().collect()):
        of = item_block(asked.filter(F.col("block") == block).collect())
        rows = written(term_rows(docs, of.vocabulary), "terms")
        documents, length, df = collection_counts(rows, len(of.vocabulary))
        weight = weights(documents, df)
        floor = seed_scores(rows, of, weight, documents, length, top)
        places = searched(rows.filter(F.size("terms") > 0), of, weight, documents, length, floor, top)
        best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        kept = written(places.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
                       .select("item_id", "rank", "doc_id", "score"), "ranked")
        out = kept if out is None else out.unionByName(kept)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = (r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + TERM + "')")

OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_SQL_TERMS.format("coalesce(text, '')")} AS terms FROM documents),
d1 AS (SELECT k, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
stats AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d1),
i AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS.format("coalesce(text, '')")}) AS term FROM benchmark),
v AS (SELECT DISTINCT term FROM i),
tf AS (SELECT u.k, u.term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, unnest(terms) AS term FROM d1) u
       JOIN v ON v.term = u.term GROUP BY u.k, u.term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term) f, stats),
scored AS (
  SELECT i.item_id, d1.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * d1.n * docs) // total)))) AS BIGINT) AS score
  FROM tf JOIN w ON w.term = tf.term JOIN i ON i.term = tf.term JOIN d1 ON d1.k = tf.k, stats
  GROUP BY i.item_id, d1.k, d1.doc_id),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM ranked WHERE place <= {TOP}"""
