"""Exact top-k search by inner product with segment statistics at several resolutions.

A vector is cut into 1, 2, 4, ... segments. Means and deviations of segments bound the distance of two vectors from below: |q - x|^2 is at
least the sum over segments of length * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2), with equality for whole vectors in the means. As
2 q.x = |q|^2 + |x|^2 - |q - x|^2, it bounds their inner product from above by the sum of length * (mean_q mean_x + dev_q dev_x). From
coarse to fine, pairs whose bound lies below the query's k-th best score so far are dropped; the rest are computed exactly.

Queries are a stated set that grows with the table, so they are taken in blocks of bounded size: each block is sent to the
tasks, which read all vectors once and keep k per query, and its result is written before the next block begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmill.llm.text import bounded_batches
from matchmill.session import stage

#: Queries of one block, and the scale of the whole numbers that components are turned into.
QUERY_BLOCK, SCALE = 2048, 1024
#: Largest product of norms for which sums of products in doubles are whole and exact.
EXACT = 2.0**52
LONG = 2**63 - 1


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def segment_features(rows: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(length) * mean and sqrt(length) * deviation of each segment, so that a bound is a product of two rows."""
    cuts = np.linspace(0, rows.shape[1], segments + 1).astype(np.int64)
    size = np.diff(cuts)
    sums = np.add.reduceat(rows, cuts[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, cuts[:-1], axis=1)
    mean = sums / size
    deviation = np.sqrt(np.maximum(squares / size - mean * mean, 0.0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([size, size]))


def resolutions(width: int) -> list[int]:
    """1, 2, 4, ... segments, of at least four components each."""
    return [1 << k for k in range(width.bit_length()) if (1 << k) * 4 <= width]


class _Block:
    """Queries of one width with their best candidates so far."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
        self.number, self.ids, self.rows, self.k = number, ids, rows, k
        self.levels = [(s, segment_features(rows, s)) for s in resolutions(rows.shape[1])]
        self.norm = float(np.sqrt((rows * rows).sum(axis=1)).max()) if rows.size else 0.0
        self.least = np.full(len(ids), -np.inf)  # the k-th best score, once there are k
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        norms = np.sqrt((rows * rows).sum(axis=1))
        slack = 1e-9 * (1.0 + self.norm * float(norms.max(initial=0.0)))
        alive = self.ids[:, None] != ids
        for segments, features in self.levels:
            live = np.flatnonzero(alive.any(axis=0))
            if not len(live) or not np.isfinite(self.least).any():
                break
            bound = features @ segment_features(rows[live], segments).T
            alive[:, live] &= bound + slack >= self.least[:, None]
        live = np.flatnonzero(alive.any(axis=0))
        if not len(live):
            return
        if self.norm * float(norms[live].max()) < EXACT:
            scores = (self.rows @ rows[live].T).astype(np.int64)
        else:  # whole numbers of any size; beyond 64 bits the nearest long stands for a score
            wide = [[int(x) for x in row] for row in rows[live]]
            scores = np.array([[max(-LONG - 1, min(LONG, sum(int(a) * b for a, b in zip(q, x, strict=True)))) for x in wide] for q in self.rows], np.int64)
            scores = scores.reshape(len(self.rows), len(live))
        alive = alive[:, live]
        for q in np.flatnonzero(alive.any(axis=1)):
            mine = alive[q]
            all_scores = np.concatenate([self.best[q][0], scores[q, mine]])
            all_ids = np.concatenate([self.best[q][1], ids[live[mine]]])
            # ~score turns the order round without the overflow that a minus sign has at the smallest long
            order = np.lexsort((all_ids, ~all_scores))[: self.k]
            self.best[q] = all_scores[order], all_ids[order]
            if len(order) == self.k:
                self.least[q] = self.best[q][0][-1]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, rows of whole numbers) for each width that vectors of a batch have."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
    for width in np.unique(sizes):
        rows = np.flatnonzero(sizes == width)
        yield ids[rows], np.floor(flat[starts[rows][:, None] + np.arange(width)] * SCALE)


def _search(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, vectors = sent.value
        sizes = np.array([len(v) for v in vectors])
        blocks = {}
        for width in np.unique(sizes):
            rows = np.flatnonzero(sizes == width)
            whole = np.floor(np.array([vectors[r] for r in rows], np.float64).reshape(len(rows), width) * SCALE)
            blocks[width] = _Block(number[rows], ids[rows], whole, k)
        for batch in batches:
            for found, rows in _vectors(batch):
                if rows.shape[1] in blocks:
                    for part in range(0, len(found), 1024):
                        blocks[rows.shape[1]].add(found[part : part + 1024], rows[part : part + 1024])
        for block in blocks.values():
            counts = [len(b[0]) for b in block.best]
            if sum(counts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(block.number, counts)), pa.array(np.repeat(block.ids, counts)),
                     pa.array(np.concatenate([b[1] for b in block.best])), pa.array(np.concatenate([b[0] for b in block.best]))],
                    names=["query", "query_id", "vec_id", "score"],
                )

    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Numbers, ids and vectors of the queries, ``size`` at a time."""
    ids, vectors, first = [], [], 0
    for row in queries.toLocalIterator():
        ids.append(row[0])
        vectors.append(np.array(row[1], np.float64))
        if len(ids) == size:
            yield np.arange(first, first + size), np.array(ids, np.int64), vectors
            ids, vectors, first = [], [], first + size
    if ids:
        yield np.arange(first, first + len(ids)), np.array(ids, np.int64), vectors


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest scores of each query row, all if there are fewer.

    Components become floor(1024 x); the score is the whole inner product, ties go to the smaller id, scores beyond 64 bits are
    the nearest long. Rows with a null id, and vectors that are null or hold null or non-finite components, take no part;
    vectors of different widths don't meet. A row's own id never answers it, so repeated rows of an id don't answer each
    other; each repeated query row gets its own answer. No query gives an empty result.
    """
    spark = vectors.sparkSession
    all_rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable("vector")
    )
    queries = vectors.filter(is_query).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable("vector")
    )
    schema = "query long, query_id long, vec_id long, score long"
    parts = []
    for part in _blocks(queries, block):
        sent = spark.sparkContext.broadcast(part)
        bounded_batches(all_rows)
        parts.append(stage(all_rows.mapInArrow(_search(sent, k), schema), "top-k"))
        sent.destroy()
    found = reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
