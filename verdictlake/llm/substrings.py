"""Substring dedup: words covered by a repeated window go, by difference-cover anchors.

A window is 13 consecutive words. Anchors are runs of 7 words that start, in
their document, at places which are 0, 1 or 3 modulo 7: a difference cover, so
any two equal windows hold an equal anchor at the same distance from their
starts, wherever they lie. Only anchors are counted for all documents. Around
anchors that occur again the match is extended: the 13-word windows over them
are hashed and compared, and the least document of each is found.

Texts lie in packs of a few megabytes. A pack sends each hash once, in one binary
row per bin of hashes, and gets back one answer per hash, so a passage that a
third of all documents share is a row per pack and never a group of its places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import table, written
from verdictlake.llm.shingles import digest, mixed, second_hashes, sequence_hashes, word_hashes

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
PACK_BYTES = 4 << 20
BIN_HASHES = 1 << 19
_COVERED = np.array([k in COVER for k in range(PERIOD)])
NO_ID = np.iinfo(np.int64).min

PACK = "doc_ids binary, digests binary, lengths binary, words long, payload binary"
SENT = "bin int, pack long, hashes binary"


def anchor_length(window: int = WINDOW, period: int = PERIOD) -> int:
    return window - period + 1


def make_packs(docs: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(pack, doc_ids, digests of the word sequences, lengths, words, payload):
    whole texts bundled in the order they are read. Written, so packs are fixed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        names, digests, texts, words, load = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([np.array(names, "<i8").tobytes()]), pa.array([b"".join(digests)]),
                 pa.array([np.array([len(t) for t in texts], "<i8").tobytes()]), pa.array([words]),
                 pa.array([press.compress(b"".join(texts))])], ["doc_ids", "digests", "lengths", "words", "payload"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                found = raw.split()
                names.append(NO_ID if name is None else name), texts.append(raw)
                digests.append(digest(word_hashes(found)))
                words, load = words + len(found), load + len(raw)
                if load >= pack_bytes:
                    yield close()
                    names, digests, texts, words, load = [], [], [], 0, 0
        if names:
            yield close()

    packs = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PACK)
    return written(packs.withColumn("pack", F.monotonically_increasing_id()), "text-packs")


class Pack:
    """One pack in a task: its documents' words and, joined, their hashes."""

    def __init__(self, row: dict):
        raw, at = zstandard.ZstdDecompressor().decompress(row["payload"], max_output_size=1 << 31) if row["payload"] else b"", 0
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        self.words: list[list[bytes]] = []
        for length in np.frombuffer(row["lengths"], "<i8"):
            self.words.append(raw[at:at + length].split())
            at += length

    def runs(self, length: int, skip: frozenset[int] = frozenset()) -> Iterator[tuple[int, np.ndarray]]:
        """(document number, word hashes) of the documents with such runs."""
        for n, words in enumerate(self.words):
            if len(words) >= length and n not in skip and self.ids[n] != NO_ID:
                yield n, word_hashes(words)


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of one document."""
    all_runs = sequence_hashes(hashes, anchor_length())
    places = np.flatnonzero(_COVERED[np.arange(len(all_runs)) % PERIOD])
    return places, all_runs[places]


def contained(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the sorted keys."""
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def by_bin(values: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The values as bytes per bin, in the order given."""
    order = np.argsort(place, kind="stable")
    used, starts = np.unique(place[order], return_index=True)
    return used.astype(np.int32), [p.tobytes() for p in np.split(values[order], starts[1:])] if len(used) else []


def sent(pack: int, bins: np.ndarray, values: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bins), pa.array(np.full(len(bins), pack)), pa.array(values, pa.binary())], ["bin", "pack", "hashes"])


def anchor_rows(packs: DataFrame, bits: int) -> DataFrame:
    """Distinct anchor hashes of each pack, by bin: 32 bits beside the bin's, and
    the top one says whether the pack holds it in several word sequences.

    Bins are added as the corpus grows, so the share of anchors that agree by
    chance stays what it is; those cost comparisons, never results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pack, found, owner, kept = Pack(row), [], [], set()
                marks = [row["digests"][i:i + 16] for i in range(0, len(row["digests"]), 16)]
                for n, hashes in pack.runs(WINDOW):
                    if marks[n] not in kept:
                        kept.add(marks[n])
                        found.append(np.unique(anchors(hashes)[1]))
                if found:
                    values, counts = np.unique(np.concatenate(found), return_counts=True)
                    place = (values >> np.uint64(64 - bits)).astype(np.int64)
                    low = (values & np.uint64(0x7FFFFFFF)).astype(np.uint32) | (np.uint32(1 << 31) * (counts > 1).astype(np.uint32))
                    yield sent(row["pack"], *by_bin(low, place))

    return packs.select("pack", "doc_ids", "digests", "lengths", "payload").mapInArrow(run, SENT)


def answered(rows: DataFrame, answer) -> DataFrame:
    """Per bin, which arrives whole: rows (pack, bin, hashes) for the packs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def replies(number: int, packs: list[int], parts: list[bytes]) -> pa.RecordBatch:
            back = [(p, v) for p, v in zip(packs, answer(parts)) if v]
            return sent(0, np.full(len(back), number, np.int32), [v for _, v in back]).set_column(1, "pack", pa.array([p for p, _ in back], pa.int64()))

        current, packs, parts = None, [], []
        for batch in batches:
            for number, pack, value in zip(*[c.to_pylist() for c in batch.columns]):
                if number != current and parts:
                    yield replies(current, packs, parts)
                    packs, parts = [], []
                current = number
                packs.append(pack), parts.append(value)
        if parts:
            yield replies(current, packs, parts)

    return rows.repartition("bin").sortWithinPartitions("bin", "pack").mapInArrow(run, SENT)


def shared_anchors(parts: list[bytes]) -> list[bytes]:
    """Of each pack's anchors those that another pack, or another sequence of
    the same pack, holds too."""
    values = [np.frombuffer(p, np.uint32) for p in parts]
    low = np.concatenate(values) & np.uint32(0x7FFFFFFF)
    several = np.concatenate(values) >> np.uint32(31) > 0
    _, inverse, counts = np.unique(low, return_inverse=True, return_counts=True)
    again = (counts[inverse] > 1) | (np.bincount(inverse, several)[inverse] > 0)
    ends = np.cumsum([len(v) for v in values])
    return [low[e - len(v):e][again[e - len(v):e]].tobytes() for v, e in zip(values, ends)]


def least_elsewhere(parts: list[bytes]) -> list[bytes]:
    """Of each pack's (window, least document) those with a smaller document in
    another pack, with that document."""
    values = [np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts]
    pairs = np.concatenate(values)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    first = np.flatnonzero(np.append(True, pairs[order][1:, 0] != pairs[order][:-1, 0]))
    least = np.empty(len(pairs), np.int64)
    least[order] = np.repeat(pairs[order][first, 1], np.diff(np.append(first, len(pairs))))
    smaller = least < pairs[:, 1]
    pairs = np.column_stack([pairs[:, 0], least])
    ends = np.cumsum([len(v) for v in values])
    return [pairs[e - len(v):e][smaller[e - len(v):e]].tobytes() for v, e in zip(values, ends)]


def with_replies(packs: DataFrame, replies: DataFrame, copies: DataFrame, run, schema: str) -> DataFrame:
    """``run(row, [(bin, bytes)], copies)`` for each pack with what came back."""
    def both(key, left: pa.Table, right: pa.Table) -> pa.Table:
        bins, values = right.column("bin").to_pylist(), right.column("hashes").to_pylist()
        skip = frozenset(int(n) for b, v in zip(bins, values) if b < 0 for n in np.frombuffer(v, np.int64))
        return run(left.to_pylist()[0], [(b, v) for b, v in zip(bins, values) if b >= 0], skip)

    answers = replies.unionByName(copies)
    return packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(both, schema)


def document_copies(packs: DataFrame) -> DataFrame:
    """Per pack, as an answer with bin -1, the numbers of its documents whose
    whole word sequence a document with a smaller id has. The least ids are
    written first: a side of known size, beside which Spark can split a digest
    that very many documents have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["doc_ids"], "<i8")
                marks = [row["digests"][i:i + 16] for i in range(0, len(row["digests"]), 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), row["pack"])), pa.array(np.arange(len(ids))), pa.array(ids, mask=ids == NO_ID), pa.array(marks, pa.binary())],
                    ["pack", "number", "doc_id", "digest"])

    facts = packs.select("pack", "doc_ids", "digests").mapInArrow(run, "pack long, number long, doc_id long, digest binary")
    least = written(facts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
                    .filter("rows > 1").drop("rows"), "least-copies")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * len(rows), pa.int32()), pa.array([r["pack"] for r in rows], pa.int64()),
                 pa.array([np.array(r["numbers"], np.int64).tobytes() for r in rows], pa.binary())], ["bin", "pack", "hashes"])

    return (facts.join(least, "digest").filter("doc_id > least").groupBy("pack").agg(F.collect_list("number").alias("numbers"))
            .mapInArrow(listed, SENT))


def window_rows(row: dict, replies: list, skip: frozenset[int], bits: int, window_bits: int) -> pa.Table:
    """The windows over shared anchors, each once with the pack's least document."""
    pack = Pack(row)
    shared: dict[int, np.ndarray] = {b: np.frombuffer(v, np.uint32) for b, v in replies}
    keys = np.unique(np.concatenate([(np.uint64(b) << np.uint64(32)) | v for b, v in shared.items()])) if shared else np.zeros(0, np.uint64)
    found, seconds, owners = [], [], []
    for n, hashes in pack.runs(WINDOW, skip):
        places, values = anchors(hashes)
        own = ((values >> np.uint64(64 - bits)) << np.uint64(32)) | (values & np.uint64(0x7FFFFFFF))
        hit = places[contained(own, keys)]
        if not len(hit):
            continue
        count = len(hashes) - WINDOW + 1
        steps = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(steps, np.maximum(hit - (PERIOD - 1), 0), 1)
        np.add.at(steps, hit + 1, -1)
        over = np.flatnonzero(np.cumsum(steps)[:count])
        found.append(sequence_hashes(hashes, WINDOW)[over]), seconds.append(second_hashes(hashes, WINDOW)[over])
        owners.append(np.full(len(over), pack.ids[n]))
    if not found:
        return pa.Table.from_batches([sent(row["pack"], np.zeros(0, np.int32), [])])
    values, seconds, owners = np.concatenate(found), np.concatenate(seconds), np.concatenate(owners)
    order = np.lexsort((owners, values))
    first = order[np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))]
    place = (seconds[first] >> np.uint64(64 - window_bits)).astype(np.int64)
    pairs = np.column_stack([values[first].view(np.int64), owners[first]])
    return pa.Table.from_batches([sent(row["pack"], *by_bin(pairs, place))])


def judged(row: dict, replies: list, skip: frozenset[int]) -> list[tuple[int, int, list[bytes], np.ndarray]]:
    """(number, id, words, whether each goes) of every document of the pack."""
    pack = Pack(row)
    runs = list(pack.runs(WINDOW, skip))
    least: dict[str, np.ndarray] = {}
    if runs:
        values = [sequence_hashes(h, WINDOW) for _, h in runs]
        owners = np.concatenate([np.full(len(v), pack.ids[n]) for (n, _), v in zip(runs, values)])
        pairs = [np.column_stack([np.concatenate(values).view(np.int64), owners])]
        pairs += [np.frombuffer(v, np.int64).reshape(-1, 2) for _, v in replies]
        joined = np.concatenate(pairs)
        order = np.lexsort((joined[:, 1], joined[:, 0]))
        joined = joined[order]
        first = np.flatnonzero(np.append(True, joined[1:, 0] != joined[:-1, 0]))
        smallest = np.empty(len(joined), np.int64)
        smallest[order] = np.repeat(joined[first, 1], np.diff(np.append(first, len(joined))))
        again = smallest[:len(owners)] < owners
        at = 0
        for (n, _), v in zip(runs, values):
            least[n] = again[at:at + len(v)]
            at += len(v)
    out = []
    for n, words in enumerate(pack.words):
        gone = np.zeros(len(words), bool)
        if n in skip and len(words) >= WINDOW:
            gone[:] = True
        elif n in least:
            steps = np.zeros(len(words) + 1, np.int64)
            hit = np.flatnonzero(least[n])
            steps[hit] += 1
            steps[hit + WINDOW] -= 1
            gone = np.cumsum(steps)[:-1] > 0
        out.append((n, int(pack.ids[n]), words, gone))
    return out


def dedup_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, text): what is left of every document.

    A word goes if a window over it also starts in a document with a smaller
    doc_id; windows are those of the input. Words are runs without ASCII white
    space; ``text`` joins the kept ones with one space.

    A null text has no words; texts below 13 words stay; of equal texts the one
    with the least id stays. Rows with one doc_id do not remove each other's
    words. A row without doc_id stays whole and removes nothing. An empty table
    gives no rows; other columns are not read.
    """
    packs = make_packs(docs)
    total = packs.agg(F.sum("words")).first()[0] or 0
    bits = max(4, int(total * len(COVER) / PERIOD / BIN_HASHES).bit_length())
    copies = written(document_copies(packs), "document-copies")
    shared = answered(anchor_rows(packs, bits), shared_anchors)
    windows = with_replies(packs, shared, copies, lambda row, replies, skip: window_rows(row, replies, skip, bits, bits), SENT)
    least = answered(windows, least_elsewhere)

    def kept(row: dict, replies: list, skip: frozenset[int]) -> pa.Table:
        found = judged(row, replies, skip)
        texts = [b" ".join([w for w, g in zip(words, gone) if not g] if gone.any() else words) for _, _, words, gone in found]
        return pa.Table.from_arrays(
            [pa.array([None if i == NO_ID else i for _, i, _, _ in found], pa.int64()), pa.array([len(w) for _, _, w, _ in found], pa.int64()),
             pa.array([int(g.sum()) for _, _, _, g in found], pa.int64()), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
            ["doc_id", "n_words", "n_removed", "text"])

    return with_replies(packs, least, copies, kept, "doc_id long, n_words long, n_removed long, text string")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document that a repeated 13-word window covers, removed."""
    return dedup_words(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
