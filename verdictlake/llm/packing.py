"""Packing token sequences into windows of near-equal load.

Documents' ids are cut into pieces of at most ``piece`` ids; windows hold 2048.
Pieces are dealt into groups of 256 windows by a hash, and each group is packed
by itself by multiway Karmarkar-Karp differencing: the two partial partitions
with the largest imbalance are merged, fullest part of one with emptiest of the
other, until one partition is left. Its parts are the group's windows; if the
fullest one exceeds the capacity, the group is packed again with one more.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import BATCH_BYTES, arrow_batches, table, written
from verdictlake.llm.tokens import encoded, id_dtype

CAPACITY = 2048
PIECE = 512
GROUP_WINDOWS = 256
GROUP_FILL = 0.995

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal the items (by number) into ``windows`` parts of near-equal sums.

    A partial partition is its parts' sums, largest first, less the smallest one,
    with the items of each; parts at 0 are left out, so merging two partitions
    costs as much as they have parts.
    """
    heap = [(-size, n, [(size, [n])]) for n, size in enumerate(sizes)]
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        free = windows - len(one) - len(other)
        if free >= 0:
            parts = one + other
        else:  # the emptiest of one (from its end) with the fullest of the other
            keep, meet = len(one) + free, -free
            parts = one[:keep] + other[meet:]
            parts += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(reversed(one[keep:]), other[:meet])]
        parts.sort(key=lambda part: -part[0])
        if len(parts) == windows and (least := parts[-1][0]):
            parts = [(size - least, items) for size, items in parts]
        heapq.heappush(heap, (-(parts[0][0] - (parts[-1][0] if len(parts) == windows else 0)), count, parts))
        count += 1
    return [items for _, items in heap[0][2]] if heap else []


def pack_group(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the sum needs, then one more
    at a time until the fullest one fits."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        dealt = differencing(sizes, windows)
        if all(sum(sizes[i] for i in part) <= capacity for part in dealt):
            return dealt
        windows += 1


def pieces(docs: DataFrame, tokenizer_file: str, piece: int = PIECE, with_ids: bool = True) -> DataFrame:
    """Encode the documents and cut each one's ids into pieces of ``piece`` ids and what is left;
    without ``with_ids`` a piece is its place, length and checksum alone."""
    kind = id_dtype(tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(value.as_buffer(), kind)
                wide, count = memoryview(values.astype("<u4").tobytes()), -(-len(values) // piece)
                for k in range(count):
                    a, b = piece * k, min(piece * (k + 1), len(values))
                    for column, v in zip(columns, (name, a, b - a, zlib.crc32(wide[4 * a:4 * b]), len(values))):
                        column.append(v)
                    if with_ids:
                        columns[5].append(values[a:b].tobytes())
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + ([pa.array(columns[5], pa.binary())] if with_ids else [])
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(arrays)])

    return encoded(docs, tokenizer_file, then=run, schema=PIECES + (", ids binary" if with_ids else ""))


def packed(cut: DataFrame, capacity: int = CAPACITY, group_windows: int = GROUP_WINDOWS) -> DataFrame:
    """Add (sequence_id, offset) to pieces.

    A task streams its pieces, which lie spread over the partitions by a hash of
    their place, and packs as soon as it holds ``group_windows`` windows, so its
    memory is bounded whatever one document or source holds. ``sequence_id`` is
    unique, not dense. The rows are final once written; they depend on how
    Spark dealt them, the packing rules do not.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 33, 0
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            nonlocal made, held
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sizes = rows.column(2).to_pylist()
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for part in pack_group(sizes, capacity):
                at = 0
                for i in part:
                    sequence[i], offset[i] = task + made, at
                    at += sizes[i]
                made += 1
            held = []
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(sequence), pa.array(offset)],
                                              [*rows.schema.names, "sequence_id", "offset"])

        load = 0
        for batch in batches:
            ends = np.cumsum(batch.column(2).to_numpy()) + load
            at = 0
            while at < batch.num_rows:
                stop = int(np.searchsorted(ends, group_windows * capacity * GROUP_FILL)) + 1
                held.append(batch.slice(at, min(stop, batch.num_rows) - at))
                if stop > batch.num_rows:
                    load = int(ends[-1])
                    break
                ends = ends - ends[stop - 1]
                load, at = 0, stop
                yield close()
        if held:
            yield close()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return cut.repartition("doc_id", "start").mapInArrow(run, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, piece: int = PIECE,
                   with_ids: bool = True) -> DataFrame:
    """Pack all documents; a row per piece with its ids and its place. Without
    ``with_ids`` no ids are moved: place and checksum say which ids are meant.

    A null text counts as empty: one piece of the end id. Repeated rows and rows
    with null or equal document ids are packed each by itself; an empty table
    gives no rows; texts of any length are cut into as many pieces as they need;
    other columns are not read, whatever their names. A window's pieces lie gapless from
    0; windows are padded to ``capacity`` by the reader.
    """
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        return written(packed(pieces(docs, tokenizer_file, piece, with_ids), capacity), "packed")


def op3_pack_sequences(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document, in sequences of at most 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", with_ids=False)
