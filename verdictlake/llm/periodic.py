"""Periodic runs of words: maximal stretches that repeat with a period.

A run of period q and length l holds, on the diagonal of lag q, l - q words that
equal the word q places on: at least ``SEED`` (6) for lags below 12, at least q
beyond. So lags fall into classes [K, 2K), whose runs all hold a K-gram that stands
again one lag further. K-grams of a document are indexed, pairs of occurrences in
a class are seeds, a seed grows both ways along its diagonal, and a table of the
furthest place covered per lag lets later seeds of the same stretch pass.

Occurrences at most K/2 apart chain up to one stretch with a period of at most
K/2. A lag between two places of one chain is a multiple of that period and no
run's smallest one, so these pairs are left out; between two chains it suffices
to pair the first place of either with all places of the other, as stepping back
one period in both keeps the lag. With that the pairs grow as the text does.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import WORD, table
from verdictlake.llm.shingles import mixed
from verdictlake.llm.tokens import byte_slices, ranges

LEAST = 12
SEED = 6
SLICE_BYTES = 4 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse among 64-bit integers


class Grams:
    """Hashes of the K-grams of many texts at once, words given as numbers.

    Equal grams of one text have equal hashes; unequal ones that share a hash are
    told apart when their seed grows, which compares words. Only the chains of
    ``far_pairs`` go by the 64-bit hash alone: a collision within one text and
    half a class of places, below 2**-40 for a million words, could join two.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray):
        def powers(base: int) -> np.ndarray:
            return np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(words), base, np.uint64))])

        self.owner = mixed(owner.astype(np.uint64) + np.uint64(1))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words.astype(np.uint64) + np.uint64(1)) * powers(_BASE)[:-1])])
        self.back = powers(pow(_BASE, -1, 1 << 64))

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        return mixed((self.sums[places + size] - self.sums[places]) * self.back[places] + self.owner[places])


def repeated(grams: Grams, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, place) of the K-grams that occur more than once in their text, by
    group and place; ``places`` ascend."""
    keys = grams.at(places, size)
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    more = ~new | np.append(~new[1:], False) if len(keys) else new
    return np.cumsum(new)[more], places[more]


def near_pairs(group: np.ndarray, place: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of all pairs of a group with a lag less than ``below``."""
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, below):
        lag = place[step:] - place[:-step]
        near = (group[step:] == group[:-step]) & (lag < below)
        if not near.any():
            break
        places.append(place[:-step][near])
        lags.append(lag[near])
    return np.concatenate(places), np.concatenate(lags)


def far_pairs(group: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the pairs with a lag in [size, 2 size) of different chains,
    one of the two the first of its chain."""
    broken = np.concatenate([[True], (group[1:] != group[:-1]) | (place[1:] - place[:-1] > size // 2)])
    chain, first = np.cumsum(broken), np.flatnonzero(broken)
    line = group * (int(place.max()) + 2 * size + 1) + place
    base = line[first] - place[first]

    def between(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a = np.searchsorted(line, base + np.maximum(low, 0))
        b = np.searchsorted(line, base + np.maximum(high, 0))
        other, one = ranges(a, b - a), np.repeat(first, b - a)
        apart = chain[one] != chain[other]
        return one[apart], other[apart]

    start = place[first]
    one, later = between(start + size, start + 2 * size)
    two, sooner = between(start - 2 * size + 1, start - size + 1)
    begin = np.concatenate([place[one], place[sooner]])
    return begin, np.concatenate([place[later], place[two]]) - begin


@lru_cache(maxsize=1 << 16)
def prime_factors(n: int) -> tuple[int, ...]:
    found, k = [], 2
    while k * k <= n:
        if n % k == 0:
            found.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return tuple(found + [n] * (n > 1))


def grown(words: np.ndarray, at: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words equal those ``lag`` places on, in a
    text from ``low`` to ``high``; empty if the word at ``at`` differs."""
    end, step = at, 32
    while end + lag < high:
        stop = min(end + step, high - lag)
        same = words[end:stop] == words[end + lag:stop + lag]
        if not same.all():
            end += int(same.argmin())
            break
        end, step = stop, step * 4
    start, step = at, 32
    while start > low and end > at:
        stop = max(start - step, low)
        same = words[stop:start] == words[stop + lag:start + lag]
        if not same.all():
            start -= int(same[::-1].argmin())
            break
        start, step = stop, step * 4
    return start, end


def smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of at least two periods has no smaller one, which would
    divide it."""
    root = words[start:start + period]
    return not any((root == words[start + period // f:start + period + period // f]).all() for f in prime_factors(period))


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs of several texts, whose words
    (equal numbers for equal words) follow each other; ``least`` is even."""
    ends = np.cumsum(sizes)
    starts, owner = ends - sizes, np.repeat(np.arange(len(sizes)), sizes)
    room = np.repeat(ends, sizes) - np.arange(len(words))
    grams, runs = Grams(words, owner), []
    places = np.flatnonzero((room >= least // 2) & (np.repeat(sizes, sizes) >= least))
    size, group = least // 2, np.zeros(0, np.int64)
    while len(places):
        first_class = size < least
        group, places = repeated(grams, places, size)
        if not len(places):
            break
        begin, lag = near_pairs(group, places, least) if first_class else far_pairs(group, places, size)
        order = np.lexsort((begin, lag, owner[begin]))
        begin, lag = begin[order], lag[order]
        text = owner[begin]
        # Seeds at neighbouring places of a diagonal: one entry, first to last.
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (lag[1:] != lag[:-1]) | (begin[1:] - begin[:-1] > 1)]) if len(begin) else np.zeros(0, bool)
        opening = np.flatnonzero(new)
        closing = np.append(opening[1:], len(begin)) - 1 if len(opening) else opening
        covered: dict[tuple[int, int], int] = defaultdict(int)  # per text and lag, the furthest place covered
        for t, q, a, b in zip(text[opening].tolist(), lag[opening].tolist(), begin[opening].tolist(), begin[closing].tolist()):
            low, high = int(starts[t]), int(ends[t])
            at = max(a, covered[t, q])
            while at <= b:
                start, end = grown(words, at, q, low, high)
                covered[t, q] = at = max(end, at + 1)
                if end - start + q >= max(least, 2 * q) and smallest(words, start, q):
                    runs.append((t, start - low, end - start + q, q))
        places = np.sort(places)
        size = least if first_class else 2 * size
        places = places[room[places] >= size]
    return sorted((t, start, q, length) for t, start, length, q in runs)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): each text's runs by start, then period,
    and its words without those that any run holds after its first period.

    A run is a stretch with smallest period q and at least max(12, 2 q) words
    that no neighbouring word extends with that period. Null and empty texts and
    those of white space have no words, no runs and an empty collapsed text.
    Texts of any length are read whole, by one task each, as a text is one value.
    Document ids may be null or repeat: each row is read by itself. An empty
    table gives no rows; other columns are not read, whatever their names.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE_BYTES):
                split = [(t or "").encode("utf-8", "surrogatepass").split() for t in part.column(1).to_pylist()]
                sizes = np.array([len(w) for w in split], np.int64)
                every = [w for words in split for w in words]
                numbers = pa.array(every, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                runs: list[list] = [[] for _ in split]
                step = np.zeros(len(every) + 1, np.int64)
                base = np.cumsum(sizes) - sizes
                for t, start, period, length in find_runs(numbers, sizes):
                    runs[t].append({"start": start, "length": length, "period": period})
                    step[base[t] + start + period] += 1
                    step[base[t] + start + length] -= 1
                kept = np.cumsum(step) == 0
                texts = [b" ".join(compress(words, kept[a:a + n].tolist()) if own else words)
                         for words, own, a, n in zip(split, runs, base, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(sizes), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of the documents whose id's crc32 divides by ten, the words
    from a place on repeat what stands there, with a period that the crc32 gives."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", F.floor(mark / 10).alias("g"),
                        F.when(mark % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("words"))
    counted = split.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    timed = counted.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))

    def word(own: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), own).otherwise(F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))

    again = F.array_join(F.transform("words", word), " ")
    return timed.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Every document's runs and collapsed text, as the longest run and digests."""
    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    top = found.withColumn("top", longest)
    return top.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(F.expr("1000 * top.length div -top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
