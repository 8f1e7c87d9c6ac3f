"""What both vector searches share: usable rows, block grids, top lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdictlake.llm.common import written

QUERY_STEP = 20
TOP = 20
FOUND = "query_id long, vec_id long, score {}"


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, embedding), each pair once, without null ids, null or empty vectors
    and vectors that hold a null or non-finite component; ``zero``: all-zero ones
    may stay."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = written(rows.filter("vec_id IS NOT NULL AND size(embedding) > 0").distinct(), "distinct-vectors")
    rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>")).filter(finite)
    return rows if zero else rows.filter(F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long arrays of doubles as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def best(scores: np.ndarray, k: int, slack: float = 0.0, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all scores that reach their row's k-th largest, less
    ``slack``; -inf never counts. With ``ids``, of the columns, the k-th largest
    among the largest score of each id."""
    if ids is not None:
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
        top = np.vstack([np.maximum.reduceat(row[order], starts) for row in scores])
    else:
        top = scores
    if top.shape[1] > k:
        least = np.partition(top, top.shape[1] - k, axis=1)[:, -k] - slack
    else:
        least = np.full(len(scores), -np.inf)
    return np.nonzero((scores >= least[:, None]) & (scores > -np.inf))


def cut(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k best, ties to smaller ids; one place per id, its best."""
    order = np.lexsort((-scores, ids, rows))
    rows_, ids_ = rows[order], ids[order]
    order = order[np.append(True, (rows_[1:] != rows_[:-1]) | (ids_[1:] != ids_[:-1]))[:len(order)]]
    order = order[np.lexsort((ids[order], -scores[order], rows[order]))]
    rows_ = rows[order]
    starts = np.flatnonzero(np.append(True, rows_[1:] != rows_[:-1]))
    rank = np.arange(len(rows_)) - np.repeat(starts, np.diff(np.append(starts, len(rows_))))
    return order[rank < k]


def ranked(found: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of what the tasks kept."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def result(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.Table:
    return pa.table({"query_id": pa.array(query_ids, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores)})


def chunks(n: int, size: int) -> Iterator[slice]:
    return (slice(i, min(i + size, n)) for i in range(0, n, size))
