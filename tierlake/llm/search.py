"""Exact top-k search by inner product: columnar branch and bound.

Candidates are laid out by dimension, the heaviest dimensions first. Scores are summed block of
dimensions by block; after each, pairs whose score so far plus the most that the remaining
dimensions can add (the product of the two remaining norms) is below the query's k-th best score
are dropped, and the survivors are compacted. Scores are whole numbers, so nothing is rounded away.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

QUERY_BYTES = 32 << 20   # queries, as 8-byte numbers, that are broadcast at once; more take further passes
SEEDS = 4096             # candidates, those of smallest hash, that give each query its first bound
DIMENSIONS = 16          # in a block
CANDIDATES = 8192        # rows laid out at once
QUERIES = 256            # queries scored together
DENSE = 0.2              # share of surviving pairs below which they are compacted
_EXACT = 2.0 ** 52       # sums below this are exact in doubles
_MOST = 2 ** 63 - 1


def taking_part(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, x array<double>) without null ids, null vectors, and null or non-finite components."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.transform(vector_column, lambda v: v.cast("double")).alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)


def _matrix(lists: list, width: int, scale: float) -> np.ndarray:
    """floor(scale * x), rows padded with zeros to ``width``."""
    found = np.zeros((len(lists), width))
    for row, values in enumerate(lists):
        found[row, :len(values)] = values
    return np.floor(found * scale)


def _remaining(rows: np.ndarray) -> np.ndarray:
    """Norm of what follows each block of dimensions, by block and row."""
    edges = range(DIMENSIONS, rows.shape[1] + DIMENSIONS, DIMENSIONS)
    return np.array([np.sqrt(np.einsum("ij,ij->i", rows[:, e:], rows[:, e:])) for e in edges])


class TopK:
    """The best candidates so far of every query: scores, falling, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, order: np.ndarray):
        self.ids, self.k, self.order = ids, k, order
        self.rows = np.ascontiguousarray(rows[:, order])
        self.remaining = _remaining(self.rows)
        self.norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.bounds = np.full(len(ids), -np.inf)

    def keep(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.found[query], ids])
        first = np.lexsort((ids, -scores))[:self.k]
        self.scores[query], self.found[query] = scores[first], ids[first]
        if len(first) == self.k:
            self.bounds[query] = max(self.bounds[query], float(scores[first[-1]]))

    def offer(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Search ``rows``, of which a query's own are passed over."""
        if not len(ids) or not len(self.ids):
            return
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        if self.norms.max() * norms.max() >= _EXACT:
            self._offer_exactly(ids, rows)
            return
        rows = rows[:, self.order]
        columns, remaining = np.ascontiguousarray(rows.T), _remaining(rows)
        for low in range(0, len(self.ids), QUERIES):
            self._offer_block(slice(low, min(low + QUERIES, len(self.ids))), ids, columns, remaining)

    def _offer_block(self, own: slice, ids: np.ndarray, columns: np.ndarray, remaining: np.ndarray) -> None:
        queries, width = self.rows[own], columns.shape[0]
        bounds = self.bounds[own]
        dense, q, c, score = np.zeros((len(queries), len(ids))), None, None, None
        for block in range(-(-width // DIMENSIONS)):
            dims = slice(block * DIMENSIONS, min((block + 1) * DIMENSIONS, width))
            if q is None:
                dense += queries[:, dims] @ columns[dims]
                most = dense + np.outer(self.remaining[block, own], remaining[block]) * (1 + 1e-9)
                alive = most + 0.5 >= bounds[:, None]
                if alive.mean() <= DENSE or dims.stop == width:
                    q, c = np.nonzero(alive)
                    score = dense[q, c]
            elif len(q):
                for d in range(dims.start, dims.stop):
                    score += queries[q, d] * columns[d, c]
                alive = score + self.remaining[block, own][q] * remaining[block, c] * (1 + 1e-9) + 0.5 >= bounds[q]
                q, c, score = q[alive], c[alive], score[alive]
        apart = self.ids[own][q] != ids[c]
        q, c, score = q[apart], c[apart], score[apart]
        starts = np.searchsorted(q, np.arange(len(queries) + 1))
        for at in np.nonzero(np.diff(starts))[0]:
            part = slice(starts[at], starts[at + 1])
            self.keep(own.start + int(at), np.rint(score[part]).astype(np.int64), ids[c[part]])

    def _offer_exactly(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Components too large for sums of doubles: whole numbers of any size, cut to a long's range."""
        whole = [[int(v) for v in row] for row in rows[:, self.order]]
        for query, own in enumerate(self.rows):
            mine = [int(v) for v in own]
            at = np.nonzero(ids != self.ids[query])[0]
            scores = [min(_MOST, max(-_MOST, sum(a * b for a, b in zip(mine, whole[k])))) for k in at]
            self.keep(query, np.array(scores, np.int64), ids[at])


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: float = 256.0, query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, id, score): of each row of ``queries`` the ``k`` best of all rows of ``vectors``.

    Both tables have the id and the vector column. Components become floor(scale * x); the score is
    the inner product, cut to the range of a long. Rows with the query's id are no candidates for
    it; equal scores go to the smaller id. With fewer than ``k`` candidates all are returned. Rows
    that take no part: see ``taking_part``. Shorter vectors count as padded with zeros. Of several
    query rows with one id the smallest vector counts; repeated candidates each count.

    Queries are broadcast in passes of bounded size, chosen by a hash of their ids; each pass scans
    all candidates once, in blocks, and each task gives back at most ``k`` rows for each query.
    """
    spark = vectors.sparkSession
    candidates = taking_part(vectors, id_column, vector_column)
    asked = taking_part(queries, id_column, vector_column).groupBy("id").agg(F.min("x").alias("x"))
    width = candidates.agg(F.max(F.size("x"))).first()[0] or 0
    number, widest = asked.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    width = max(1, width, widest or 0)
    passes = max(1, -(-number * width * 8 // query_bytes))
    seeds = candidates.orderBy(F.xxhash64("id"), "id", "x").limit(SEEDS).collect()
    seed_ids = np.array([r["id"] for r in seeds], np.int64)
    seed_rows = _matrix([r["x"] for r in seeds], width, scale)
    order = np.argsort(-np.einsum("ij,ij->j", seed_rows, seed_rows), kind="stable")

    found = None
    for part in range(passes):
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == part).orderBy("id").collect()
        ids, rows = np.array([r["id"] for r in block], np.int64), _matrix([r["x"] for r in block], width, scale)
        seeded = TopK(ids, rows, k, order)
        seeded.offer(seed_ids, seed_rows)
        shared = spark.sparkContext.broadcast((ids, rows, seeded.bounds))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, rows, bounds = shared.value
            best = TopK(ids, rows, k, order)
            best.bounds = bounds.copy()
            for batch in batches:
                for low in range(0, batch.num_rows, CANDIDATES):
                    piece = batch.slice(low, CANDIDATES)
                    best.offer(piece.column(0).to_numpy(), _matrix(piece.column(1).to_pylist(), width, scale))
            sizes = [len(s) for s in best.scores]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate(best.found)),
                     pa.array(np.concatenate(best.scores))], ["query_id", "id", "score"])

        rows_found = candidates.mapInArrow(search, "query_id long, id long, score long")
        found = rows_found if found is None else found.unionAll(rows_found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
