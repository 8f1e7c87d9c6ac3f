"""Token ids as files of Huffman-coded blocks, and reading them back.

Codes are canonical and length-limited, made from global id counts by the
package-merge method (Larmore and Hirschberg 1990). A file row is a block: whole
documents in ascending order of id, a bit string, and the bit offset of every
512th id. A block is decoded without any other one, by table look-up, all its
checkpoints side by side. Blocks are rows of a Parquet table, so any store that
Spark writes to holds them and a lost task leaves no half file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdictlake.llm.common import table, written
from verdictlake.llm.tokens import encoded, id_dtype
from verdictlake.session import work_path

MAX_BITS = 18
BLOCK_IDS = 65_536
CHECKPOINT_IDS = 512
BLOCK = ("shard int, block int, first long, n_tokens long, doc_ids binary, doc_lengths binary, "
         "payload binary, checkpoints binary")


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each symbol, none above ``max_bits`` (0: unused).

    Package-merge: on each level the symbols, sorted by count, merge with pairs
    of the level below; how many symbols are among the items that count, level
    by level from the top, says how many of the rarest symbols get a longer code.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(len(used) - 1).bit_length())
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    levels, items = [], weights
    for _ in range(max_bits - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([weights, pairs])
        order = np.argsort(merged, kind="stable")
        levels.append(np.cumsum(order < len(weights)))
        items = merged[order]
    take = 2 * len(used) - 2
    for symbols in reversed(levels):
        leaves = int(symbols[take - 1]) if take else 0
        lengths[used[:leaves]] += 1
        take = 2 * (take - leaves)
    lengths[used[:take]] += 1
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes of increasing length, within a length in order of symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    if len(used):
        order = used[np.lexsort((used, lengths[used]))]
        top = int(lengths.max())
        steps = np.uint64(1) << (top - lengths[order]).astype(np.uint64)
        starts = np.cumsum(steps) - steps
        codes[order] = starts >> (top - lengths[order]).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For each string of the longest code's bits: symbol * 64 + length."""
    used = np.flatnonzero(lengths)
    if not len(used):
        return np.zeros(2, np.int64)
    order = used[np.lexsort((used, lengths[used]))]
    top = int(lengths.max())
    entries = order.astype(np.int64) * 64 + lengths[order]
    full = np.repeat(entries, 1 << (top - lengths[order].astype(np.int64)))
    return np.concatenate([full, np.full((1 << top) - len(full), 64 * 0 + top, np.int64)])


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The bit string of ``ids`` and the bit offset of every ``every``-th one."""
    size = lengths[ids].astype(np.int64)
    at = np.cumsum(size) - size
    bits = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    merged = np.bitwise_or.reduceat(bits, starts)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[starts]] |= merged >> np.uint64(32)
    out[word[starts] + 1] |= merged & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes(), at[::every]


def unpack(payloads: list[bytes], offsets: list[np.ndarray], totals: list[int], table_: np.ndarray,
           every: int) -> list[np.ndarray]:
    """The ids of several blocks: every checkpoint is a lane, and all lanes step
    from id to id together."""
    bits = int(len(table_) - 1).bit_length()
    words = [np.frombuffer(p, ">u4").astype(np.uint64) for p in payloads]
    base = np.cumsum([0, *[len(w) + 1 for w in words]])
    joined = np.concatenate([np.append(w, np.uint64(0)) for w in words] + [np.zeros(1, np.uint64)])
    pairs = (joined[:-1] << np.uint64(32)) | joined[1:]
    at = np.concatenate([o.astype(np.int64) + (b << 5) for o, b in zip(offsets, base)])
    rest = np.uint64(64 - bits)
    last = len(pairs) - 1
    out = np.empty((len(at), every), np.uint32)
    for step in range(every):
        window = (pairs[np.minimum(at >> 5, last)] << (at & 31).astype(np.uint64)) >> rest
        entry = table_[window.astype(np.int64)]
        out[:, step] = entry >> 6
        at += entry & 63
    result, lane = [], 0
    for offset, total in zip(offsets, totals):
        result.append(out[lane:lane + len(offset)].reshape(-1)[:total])
        lane += len(offset)
    return result


def id_counts(ids: DataFrame, kind: str) -> DataFrame:
    """(id, n) over all documents; each task adds up its own before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            counts = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(counts) > len(total):
                total = np.pad(total, (0, len(counts) - len(total)))
            total[: len(counts)] += counts
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_book(ids: DataFrame, kind: str, max_bits: int = MAX_BITS) -> np.ndarray:
    """Code lengths by id. The counts that reach the driver are one row per
    distinct id: bounded by the vocabulary, whatever the number of texts."""
    rows = id_counts(ids, kind).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    return code_lengths(counts, max_bits)


def write_blocks(ids: DataFrame, path: str, lengths: np.ndarray, kind: str,
                 block_ids: int = BLOCK_IDS, every: int = CHECKPOINT_IDS) -> None:
    """Write (doc_id, ids) as blocks in ascending order of doc_id (null first,
    equal ids by their token ids). A shard is a range of document ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shard = canonical_codes(lengths), TaskContext.get().partitionId()
        names, sizes, parts, held, block, first = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            payload, marks = pack(np.concatenate(parts), codes, lengths, every)
            has = np.array([n is not None for n in names])
            values = np.where(has, [n or 0 for n in names], np.iinfo(np.int64).min)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([first]), pa.array([held]),
                 pa.array([values.astype("<i8").tobytes()]), pa.array([np.array(sizes, "<i8").tobytes()]),
                 pa.array([payload]), pa.array([marks.astype("<i8").tobytes()])],
                ["shard", "block", "first", "n_tokens", "doc_ids", "doc_lengths", "payload", "checkpoints"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(value.as_py(), kind)
                names.append(name), sizes.append(len(part)), parts.append(part)
                held += len(part)
                if held >= block_ids:
                    yield close()
                    first, block = first + held, block + 1
                    names, sizes, parts, held = [], [], [], 0
        if names:
            yield close()

    (ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
     .mapInArrow(run, BLOCK).write.parquet(path))


def read_documents(spark: SparkSession, path: str, lengths: np.ndarray, every: int = CHECKPOINT_IDS,
                   blocks_at_once: int = 64) -> DataFrame:
    """(doc_id, start, n_tokens, ids) read back from blocks; ``start`` counts the
    ids of all documents before. Only sums per shard, a row each, meet in one
    window; they are written, so that the files meet a table of known size."""
    files = spark.read.schema(BLOCK).parquet(path)
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
                    .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "shard-bases")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = decoding_table(lengths)
        for whole in batches:
            for batch in (whole.slice(i, blocks_at_once) for i in range(0, whole.num_rows, blocks_at_once)):
                row = batch.to_pydict()
                blocks = unpack(row["payload"], [np.frombuffer(c, "<i8") for c in row["checkpoints"]], row["n_tokens"], book, every)
                for k, ids in enumerate(blocks):
                    names, sizes = np.frombuffer(row["doc_ids"][k], "<i8"), np.frombuffer(row["doc_lengths"][k], "<i8")
                    ends = np.cumsum(sizes)
                    raw = memoryview(ids.astype("<u4").tobytes())
                    texts = [bytes(raw[4 * (e - s):4 * e]) for s, e in zip(sizes, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, mask=names == np.iinfo(np.int64).min), pa.array(row["base"][k] + row["first"][k] + ends - sizes),
                         pa.array(sizes), pa.array(texts, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return (files.join(bases, "shard").select("base", "first", "n_tokens", "doc_ids", "doc_lengths", "payload", "checkpoints")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary"))


def encode_to_files(docs: DataFrame, path: str, tokenizer_file: str, max_bits: int = MAX_BITS) -> np.ndarray:
    """Encode all texts, write them to ``path``, return the code book (lengths by
    id), which reading needs.

    Null texts are empty and hold the end id alone; empty tables write no block;
    repeated rows are written as often; null document ids come first; other
    columns are not read.
    """
    kind = id_dtype(tokenizer_file)
    ids = written(encoded(docs, tokenizer_file), "token-ids")
    lengths = code_book(ids, kind, max_bits)
    write_blocks(ids, path, lengths, kind)
    return lengths


def op1_token_files(spark, sf_dir: str) -> DataFrame:
    """Every document's ids through the block files and back."""
    path = work_path(spark, "token-files")
    lengths = encode_to_files(table(spark, sf_dir, "documents"), path, "word_bpe_49k.json")
    back = read_documents(spark, path, lengths)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
