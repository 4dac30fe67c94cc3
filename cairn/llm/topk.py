"""Exact top-k inner products by no-random-access aggregation.

Vectors become integers, floor(64 x). A query's score is a sum over one list
per dimension, each sorted by value. Queries and candidates are dealt in blocks,
every query block meets every candidate block once (a stated query set against
all rows). Within a block pair the lists are read from both ends inwards, all to
the same depth. What a candidate's entries read so far add is known; each of the
others lies between the two reading positions of its list, which bounds the
score from below and from above. Reading goes on while too many candidates can
still reach the k-th best lower bound, to the lists' ends if need be; then each
query's own candidates alone, the few that are left, get their final scores. All
queries of a block are bounded at once by matrix products over the entries read.
A last ranking joins the blocks' answers.

(Read from the top alone, as the textbook does, an entry not seen is bounded from
below by the least of its list, and on vectors of many like dimensions nothing
settles before the end. The far ends bound both sides.)

Defined results: vectors that are null, or hold null or non-finite components,
take no part, nor do rows without an id; vectors of another length than the
query's don't meet it. Ties go to the smaller vec_id. Rows that repeat a
vec_id are candidates of their own, except against the id itself; a repeated
query id is one query for its smallest vector. Queries without candidates
give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import matrices

#: Rows in a candidate block and queries in a query block, on average.
CANDIDATES, QUERIES = 8192, 1024
#: Queries of a block that are bounded at once.
AT_ONCE = 256
#: Shares of the lists read, half from each end, at which bounds are compared.
DEPTHS = (0.5, 0.8, 0.9, 0.95, 1.0)
#: Reading stops when at most this share of the candidates is left on average.
FEW = 0.05


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key_, q: usable rows as integers."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0))
        .where(usable)
        .select(F.col(key).cast("long").alias("key_"), F.transform(values, lambda x: F.floor(x * 64)).alias("q"))
    )


def block_topk(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) of the k best candidates a query, ties to
    the smaller id. Matrices of float64 that hold integers. Some queries at a
    time, which bounds memory."""
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    places = np.argsort(np.argsort(c, axis=0, kind="stable"), axis=0, kind="stable")  # in each sorted list
    ordered = np.sort(c, axis=0)
    found = []
    for at in range(0, len(q), AT_ONCE):
        rows, cols, scores = settled(qid[at : at + AT_ONCE], q[at : at + AT_ONCE], cid, c, places, ordered, k)
        found.append((rows + at, cid[cols], scores))
    return tuple(np.concatenate(part) for part in zip(*found))


def candidates_left(q, own, c, places, ordered, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which candidates may be among a query's k best, what their entries read
    add, which entries are read). ``own`` marks the query's own rows."""
    n = len(c)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    for depth in DEPTHS:
        ends = int(n * depth / 2) if depth < 1 else n
        read = (places < ends) | (places >= n - ends)
        low, high = ordered[min(ends, n - 1)], ordered[max(n - 1 - ends, 0)]  # the reading positions
        exact = q @ (c * read).T
        rest = (~read).T.astype(np.float64)
        lower = exact + (up * low + down * high) @ rest
        upper = exact + (up * high + down * low) @ rest
        lower[own], upper[own] = -np.inf, -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
        left = (upper >= kth[:, None]) & ~own  # an equal score may win by its id
        if left.sum() <= max(k, FEW * n) * len(q):
            break
    return left, exact, read


def settled(qid, q, cid, c, places, ordered, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the k best a query."""
    own = cid[None, :] == qid[:, None]
    left, exact, read = candidates_left(q, own, c, places, ordered, k)
    rows, cols = np.nonzero(left)
    scores = exact[rows, cols]
    for at in range(0, len(rows), 1 << 16):  # the entries not read, of candidates left only
        r, x = rows[at : at + (1 << 16)], cols[at : at + (1 << 16)]
        scores[at : at + (1 << 16)] += np.einsum("ij,ij->i", q[r], c[x] * ~read[x])
    best = np.lexsort((cols, -scores, rows))  # rows of candidates are in the order of their ids
    rows, cols, scores = rows[best], cols[best], scores[best]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    return rows[place < k], cols[place < k], scores[place < k].astype(np.int64)


def search(queries: DataFrame, candidates: DataFrame, k: int = 20, n_queries: int | None = None, n_candidates: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: both frames as :func:`quantised` gives."""
    n_queries = queries.count() if n_queries is None else n_queries
    n_candidates = candidates.count() if n_candidates is None else n_candidates
    q_blocks, c_blocks = max(1, -(-n_queries // QUERIES)), max(1, -(-n_candidates // CANDIDATES))
    dealt = lambda n: F.pmod(F.xxhash64("key_", "q"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    once = queries.groupBy("key_").agg(F.min("q").alias("q"))
    left = once.withColumn("qb", dealt(q_blocks)).withColumn("cb", every(c_blocks))
    right = candidates.withColumn("cb", dealt(c_blocks)).withColumn("qb", every(q_blocks))
    schema = "query_id long, vec_id long, score long"

    def meet(qs: pa.Table, cs: pa.Table) -> pa.Table:
        parts, other = [[np.empty(0, np.int64)] * 3], matrices(cs)
        for dims, (mine, vectors) in matrices(qs).items():
            if dims in other:
                theirs, held = other[dims]
                qid, cid = qs.column("key_").to_numpy()[mine], cs.column("key_").to_numpy()[theirs]
                rows, ids, scores = block_topk(qid, vectors.astype(np.float64), cid, held.astype(np.float64), k)
                parts.append([qid[rows], ids, scores])
        return pa.table([pa.array(np.concatenate(col)) for col in zip(*parts)], names=["query_id", "vec_id", "score"])

    met = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, schema)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        met.withColumn("rank", place.cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k(vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows of ``vectors`` that fulfil ``is_query`` (a condition on the key),
    against all other rows."""
    rows = quantised(vectors, key, vector)
    queries = rows.where(is_query(F.col("key_")))
    return search(queries, rows, k)
