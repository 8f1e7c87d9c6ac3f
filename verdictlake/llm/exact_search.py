"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into equal segments; each has a mean m and a deviation s. For two
vectors, length * ((m - m')^2 + (s - s')^2) summed over segments is at most their
squared distance, so length * (m m' + s s') is at least their inner product. The
bound tightens as segments get shorter: pairs that cannot reach a query's k-th
best score are dropped from coarse to fine, the rest is computed exactly.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdictlake.llm.common import table
from verdictlake.llm.vectors import FOUND, QUERY_STEP, TOP, best, chunks, cut, matrix, ranked, result, usable

SCALE = 64
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 16_384
LEVELS = (2, 8, 32)
EXACT = 1 << 52


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, times the root of its length, side
    by side: the inner product of two such rows is the bound."""
    dim = vectors.shape[1]
    width = -(-dim // segments)
    padded = np.pad(vectors, ((0, 0), (0, width * segments - dim))).reshape(len(vectors), segments, width)
    return np.hstack([padded.mean(axis=2), padded.std(axis=2)]) * np.sqrt(width)


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """(query number, place, score) of each query's k best ids in a block of
    vectors, by an id's best vector."""
    limit = float(np.abs(vectors).max(initial=0) * np.abs(queries).max(initial=0) * vectors.shape[1])
    if limit >= EXACT:  # beyond what doubles add exactly: whole numbers (a score must fit a long)
        whole = [np.array([[int(x) for x in row] for row in v], object) for v in (queries, vectors)]
        rows, places, kept = [], [], []
        for q, query in enumerate(whole[0]):  # one query's scores at a time
            scores, top = whole[1] @ query, {}
            for p in np.flatnonzero(ids != query_ids[q]).tolist():
                if ids[p] not in top or scores[p] > scores[top[ids[p]]]:
                    top[ids[p]] = p
            for p in heapq.nsmallest(k, top.values(), key=lambda p: (-scores[p], ids[p])):
                rows.append(q), places.append(p), kept.append(scores[p])
        return np.array(rows, np.int64), np.array(places, np.int64), np.array(kept, np.int64)

    slack = 1e-9 * (1 + limit)
    levels = [s for s in LEVELS if s < vectors.shape[1]] or [1]
    stats = [(statistics(queries, s), statistics(vectors, s)) for s in levels]
    firsts = np.unique(ids, return_index=True)[1]  # one place per id
    repeats = ids if len(firsts) < len(ids) else None
    found = []
    for part in chunks(len(queries), 128):
        own = query_ids[part, None] == ids[None, :]
        bound = stats[0][0][part] @ stats[0][1].T
        bound[own] = -np.inf
        # The k most promising ids of each query give a score that the k-th best reaches.
        first = min(k, len(firsts))
        likely = np.argpartition(bound if repeats is None else bound[:, firsts], len(firsts) - first, axis=1)[:, -first:]
        likely = likely if repeats is None else firsts[likely]
        scored = np.einsum("qd,qkd->qk", queries[part], vectors[likely])
        scored[np.take_along_axis(own, likely, axis=1)] = -np.inf
        least = scored.min(axis=1) if first == k else np.full(len(bound), -np.inf)
        alive = (bound >= least[:, None] - slack) & ~own
        for left, right in stats[1:]:
            share = alive.mean()
            if share > 0.2:  # nearly all are left: the bound of all pairs at once
                alive &= left[part] @ right.T >= least[:, None] - slack
            else:
                q, p = np.nonzero(alive)
                for s in chunks(len(q), 1 << 18):
                    drop = np.einsum("nd,nd->n", left[part][q[s]], right[p[s]]) < least[q[s]] - slack
                    alive[q[s][drop], p[s][drop]] = False
        scores = np.full(alive.shape, -np.inf)
        if alive.mean() > 0.2:
            scores[alive] = (queries[part] @ vectors.T)[alive]
        else:
            q, p = np.nonzero(alive)
            for s in chunks(len(q), 1 << 18):
                scores[q[s], p[s]] = np.einsum("nd,nd->n", queries[part][q[s]], vectors[p[s]])
        q, p = best(scores, k, ids=repeats)
        keep = cut(q, ids[p], scores[q, p], k)
        found.append((q[keep] + part.start, p[keep], scores[q[keep], p[keep]]))
    rows, places, scores = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return rows, places, np.rint(scores).astype(np.int64)


def exact_top_k(vectors: DataFrame, *, k: int = TOP, step: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) by the inner product of floor(scale * x).

    Queries are the rows whose vec_id is divisible by ``step``; candidates all
    rows but the query's own (rows with its vec_id). Query blocks meet candidate
    blocks of bounded size on a grid; each cell keeps at most k rows per query.

    Rows with a null id, a null or empty vector or a null or non-finite component
    take no part; vectors meet only those of their length; of rows that repeat a
    vec_id a list holds the best one, as candidate and as query, and the others
    take no place; an empty table gives no rows; other columns are not read. A
    score must fit a long: |scale * x| below 2**31 does at 2 components or fewer,
    below 2**26 at up to 2,048.
    """
    rows = usable(vectors, zero=True).withColumn("dim", F.size("embedding"))
    query = F.col("vec_id") % step == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(query, 1))).first()
    across, down = -(-n_queries // QUERY_BLOCK) or 1, -(-n // CANDIDATE_BLOCK) or 1
    spread = F.xxhash64("vec_id", "embedding")  # an id with many vectors is dealt out, too
    queries = rows.filter(query).withColumns({"q": F.pmod(spread, F.lit(across)), "c": F.explode(F.sequence(F.lit(0), F.lit(down - 1)).cast("array<long>"))})
    candidates = rows.withColumns({"c": F.pmod(spread, F.lit(down)), "q": F.explode(F.sequence(F.lit(0), F.lit(across - 1)).cast("array<long>"))})

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return result([], [], np.zeros(0, np.int64))
        query_ids, ids = (t.column("vec_id").to_numpy() for t in (left, right))
        quantised = [np.floor(scale * matrix(t.column("embedding"))) for t in (left, right)]
        rows_, places, scores = search_block(quantised[0], query_ids, quantised[1], ids, k)
        return result(query_ids[rows_], ids[places], scores)

    found = (queries.groupBy("dim", "q", "c").cogroup(candidates.groupBy("dim", "q", "c"))
             .applyInArrow(cell, FOUND.format("long")))
    return ranked(found, k)


def op4_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector."""
    return exact_top_k(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.e, c.e) AS BIGINT)) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) r WHERE rank <= 20"""
