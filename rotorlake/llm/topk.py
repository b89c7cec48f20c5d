"""Exact top-k inner-product search, a block at a time.

Vectors are integers. Documents are cut into blocks of a range of the order they are dealt in; a block's forward index
holds its vectors and, for each term (dimension), the largest and the smallest weight. For a query the bound of a
block is the sum over terms of weight times the term's extreme. Blocks are visited by falling bound; when the next
bound lies below the query's k-th score so far, no block that is left can matter.

Queries and documents are both dealt into shards, and every pair of shards is one task with a bounded number of rows:
the stated query set meets all rows in blocks. Each task hands over k rows a query at most.

Defined results: vectors that are null, or hold a null or a value that is not finite, take no part; vectors of another
length than the first valid one of a shard pair score over the common terms as if the rest were 0; equal scores go by
the smaller id; repeated rows are candidates each; null ids take no part; a query never finds its own id. Scores
beyond 64 bits wrap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 256
DOC_SHARD = 16_384
QUERY_SHARD = 4_096


def integers(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def valid(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(True))


class Blocks:
    """Forward indexes of the blocks of one shard, with the extremes of every term."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, block_rows: int) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.starts = np.arange(0, len(ids), block_rows)
        self.most = np.maximum.reduceat(self.rows, self.starts, axis=0)
        self.least = np.minimum.reduceat(self.rows, self.starts, axis=0)
        self.ends = np.append(self.starts[1:], len(ids))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest score that each block can hold for each query."""
        return np.maximum(queries, 0) @ self.most.T + np.minimum(queries, 0) @ self.least.T


def search(blocks: Blocks, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query id, document id and score of each query's k best (ties by id), and the number of blocks scored."""
    bound = blocks.bounds(queries)
    turn = np.argsort(-bound, axis=1, kind="stable")
    n, wide = bound.shape
    best = np.full((n, k), np.iinfo(np.int64).min, np.int64)
    name = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    have = np.zeros((n, k), np.bool_)
    active, scored = np.arange(n), 0
    for step in range(wide):
        mine = turn[active, step]
        # The k-th score so far; a full list whose k-th lies above the bound is final.
        open_ = ~have[active, k - 1] | (bound[active, mine] >= best[active, k - 1])
        active, mine = active[open_], mine[open_]
        if not len(active):
            break
        for b in np.unique(mine).tolist():
            own = active[mine == b]
            lo, hi = blocks.starts[b], blocks.ends[b]
            scored += len(own)
            score = (queries[own] @ blocks.rows[lo:hi].T).astype(np.int64)
            docs = np.broadcast_to(blocks.ids[lo:hi], score.shape)
            real = docs != ids[own][:, None]
            score = np.concatenate([best[own], score], axis=1)
            docs = np.concatenate([name[own], docs], axis=1)
            real = np.concatenate([have[own], real], axis=1)
            order = np.lexsort((docs, -score, ~real), axis=1)[:, :k]
            best[own], name[own], have[own] = (np.take_along_axis(x, order, 1) for x in (score, docs, real))
    q, c = np.nonzero(have)
    return ids[q], name[q, c], best[q, c], scored


def _matrix(lists: pa.Array, terms: int) -> np.ndarray:
    """Rows of a list column as floats where sums stay exact, else as integers; short rows are filled with 0."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(sizes) and (sizes == terms).all():
        return flat.reshape(len(sizes), terms)
    out = np.zeros((len(sizes), terms), np.int64)
    row, at = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = at < terms
    out[row[keep], at[keep]] = flat[keep]
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    doc_shard: int = DOC_SHARD,
    query_shard: int = QUERY_SHARD,
) -> DataFrame:
    """Each query's k best candidates: query_id, rank, vec_id, score."""
    rows = vectors.where(F.col(vec_id).isNotNull() & valid(vector)).select(
        F.col(vec_id).cast("long").alias("id"), integers(vector, scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    total = rows.agg(F.count(F.lit(1)), F.sum(F.col("q").cast("long")), F.max(F.size("v"))).first()
    n, n_query, terms = total[0], total[1] or 0, total[2] or 0
    d_shards, q_shards = max(1, -(-n // doc_shard)), max(1, -(-n_query // query_shard))
    own = F.xxhash64("id", "v")
    cell = lambda q, d: (q * F.lit(d_shards) + d).cast("long")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    docs = rows.withColumn("d", F.pmod(own, F.lit(d_shards))).withColumn("s", every(q_shards))
    docs = docs.select(cell(F.col("s"), F.col("d")).alias("cell"), "id", "v")
    asked = rows.where("q").withColumn("s", F.pmod(own, F.lit(q_shards))).withColumn("d", every(d_shards))
    asked = asked.select(cell(F.col("s"), F.col("d")).alias("cell"), "id", "v")

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({x: pa.array([], pa.int64()) for x in names})
        found, asks = _matrix(left.column("v"), terms), _matrix(right.column("v"), terms)
        # Sums below 2^53 are exact in floating point, for which numpy has fast products.
        reach = float(np.abs(found).max(initial=0)) * float(np.abs(asks).max(initial=0)) * max(1, terms)
        if reach < 2**53:
            found, asks = found.astype(np.float64), asks.astype(np.float64)
        blocks = Blocks(left.column("id").to_numpy(), found, block_rows)
        got = search(blocks, right.column("id").to_numpy(), asks, k)
        return pa.table(dict(zip(names, got[:3], strict=True)))

    pairs = asked.groupBy("cell").cogroup(docs.groupBy("cell"))
    best = pairs.applyInArrow(lambda key, a, b: run(key, b, a), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
