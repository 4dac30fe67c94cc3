"""Hard negatives by exact scores from residue products.

Vectors become integers, floor(scale x). A matrix of scores is not multiplied as
such: its factors are reduced modulo a few primes, each pair of residue matrices
is multiplied in float32 (exact, as no partial sum reaches 2^24), and the signed
scores follow from their residues by Chinese remaindering. The number of primes
follows from the largest possible score.

Anchors and rows are dealt in blocks by their ids, and every anchor block meets
every row block once (a stated query set against all rows), twice over:

1. positives: an anchor's best other rows of its label. Within a cell only the
   rows of one label are multiplied with each other;
2. negatives: for each positive a window of scores, ``low`` to ``high`` percent of
   the positive's; the best rows of other labels inside it.

Each cell hands on a few rows for each anchor; a last ranking joins the cells.

Defined results: rows with a null id, label or vector, an empty vector, or a null
or non-finite component take no part. Vectors of another length than the
anchor's don't meet it. Ties go to the smaller id. Rows that share the anchor's
id are never its positives or negatives; else repeated rows count each. A
repeated anchor id is one anchor, for its smallest (label, vector). Anchors
without positives, and positives whose window is empty (as with a negative
score), give no rows. Other columns of the input don't matter. Scores that could
reach 2^50 raise an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import matrices, written

#: Rows in an anchor block and in a row block, on average.
ANCHORS, ROWS = 4096, 8192
#: Anchors of a block that are scored at once.
AT_ONCE = 512
#: Dimensions in one product: residues of at most 511 keep its sums under 2^24.
DIMS = 64
LARGEST = 1023


def primes_for(bound: int) -> list[int]:
    """The largest primes up to ``LARGEST`` whose product exceeds twice ``bound``."""
    found, product, p = [], 1, LARGEST
    while product <= 2 * bound + 1:
        if all(p % d for d in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
        p -= 1
    return found


def residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Balanced residues, at most (p - 1) / 2 in size, of integers in float64."""
    r = np.fmod(matrix, p)
    return (r - p * np.rint(r / p)).astype(np.float32)


class Factor:
    """A block of integer vectors, reduced modulo each prime."""

    def __init__(self, matrix: np.ndarray, primes: list[int]):
        self.primes, self.parts = primes, [residues(matrix, p) for p in primes]

    def rows(self, which) -> Factor:
        some = Factor.__new__(Factor)
        some.primes, some.parts = self.primes, [part[which] for part in self.parts]
        return some

    def scores(self, other: Factor) -> np.ndarray:
        """All inner products with ``other``'s rows: exact signed longs.

        Mixed-radix digits: score = d0 + p0 (d1 + p1 (d2 + ...)), each digit from
        the residue of its prime; the upper half of the range is negative."""
        value, product = None, 1
        for p, a, b in zip(self.primes, self.parts, other.parts):
            found = 0
            for at in range(0, a.shape[1], DIMS):
                found = (found + (a[:, at : at + DIMS] @ b[:, at : at + DIMS].T).astype(np.int64)) % p
            if value is None:
                value = found
            else:
                value += product * ((found - value) % p * pow(product, -1, p) % p)
            product *= p
        value[value > product // 2] -= product
        return value


def usable(vectors: DataFrame, key: str, label: Column, vector: str, scale: int) -> DataFrame:
    """key_, label_, q (integers as doubles) of the rows that take part."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.where(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0))
        .where(good)
        .select(F.col(key).cast("long").alias("key_"), label.cast("long").alias("label_"), F.transform(values, lambda x: F.floor(x * scale).cast("double")).alias("q"))
    )


def best_of_label(anchors: pa.Table, rows: pa.Table, primes: list[int], k: int) -> pa.Table:
    """anchor_id, positive_id, positive_score: the k best rows of an anchor's label."""
    out: list[tuple] = []
    other = matrices(rows)
    for dims, (mine, q) in matrices(anchors).items():
        if dims not in other:
            continue
        theirs, c = other[dims]
        a_id, a_label = _ids(anchors, mine)
        c_id, c_label = _ids(rows, theirs)
        order = np.lexsort((c_id, c_label))
        c_id, c_label, right = c_id[order], c_label[order], Factor(c, primes).rows(order)
        left = Factor(q, primes)
        for label in np.unique(a_label):
            lo, hi = np.searchsorted(c_label, label, "left"), np.searchsorted(c_label, label, "right")
            members = np.flatnonzero(a_label == label)
            for at in range(0, len(members) if hi > lo else 0, AT_ONCE):
                some = members[at : at + AT_ONCE]
                scores = left.rows(some).scores(right.rows(slice(lo, hi)))
                for row, i in zip(scores, a_id[some].tolist()):
                    others = np.flatnonzero(c_id[lo:hi] != i)
                    if len(others) > k:
                        edge = np.partition(row[others], len(others) - k)[len(others) - k]
                        others = others[row[others] >= edge]
                    best = others[np.argsort(-row[others], kind="stable")][:k]  # ties stay in the order of ids
                    out.append((np.full(len(best), i), c_id[lo:hi][best], row[best]))
    return _table(out, ["anchor_id", "positive_id", "positive_score"])


def best_in_windows(anchors: pa.Table, rows: pa.Table, primes: list[int], k: int, low: int, high: int) -> pa.Table:
    """anchor_id, place (of the positive), negative_id, negative_score: the k best
    rows of another label in each positive's window."""
    out: list[tuple] = []
    other = matrices(rows)
    found = anchors.column("positives").combine_chunks()
    ends, positive = found.offsets.to_numpy(), found.flatten().to_numpy(zero_copy_only=False)
    ends = ends - ends[0]
    least, most = -(-low * positive // 100), high * positive // 100
    for dims, (mine, q) in matrices(anchors).items():
        if dims not in other:
            continue
        theirs, c = other[dims]
        a_id, a_label = _ids(anchors, mine)
        c_id, c_label = _ids(rows, theirs)
        order = np.argsort(c_id, kind="stable")
        c_id, c_label, right, left = c_id[order], c_label[order], Factor(c[order], primes), Factor(q, primes)
        for at in range(0, len(mine), AT_ONCE):
            scores = left.rows(slice(at, at + AT_ONCE)).scores(right)
            for row, i, label, n in zip(scores, a_id[at:].tolist(), a_label[at:].tolist(), mine[at:].tolist()):
                lows, highs = least[ends[n] : ends[n + 1]], most[ends[n] : ends[n + 1]]
                wide = np.flatnonzero((row >= lows.min()) & (row <= highs.max()) & (c_label != label) & (c_id != i))
                wide = wide[np.argsort(-row[wide], kind="stable")]  # ties stay in the order of ids
                falling = -row[wide]
                for place, (lo, hi) in enumerate(zip(lows, highs)):
                    first, end = np.searchsorted(falling, -hi, "left"), np.searchsorted(falling, -lo, "right")
                    best = wide[first : min(end, first + k)]
                    out.append((np.full(len(best), i), np.full(len(best), place), c_id[best], row[best]))
    return _table(out, ["anchor_id", "place", "negative_id", "negative_score"])


def _ids(table: pa.Table, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return table.column("key_").to_numpy()[rows], table.column("label_").to_numpy()[rows]


def _table(parts: list[tuple], names: list[str]) -> pa.Table:
    cols = zip(*parts) if parts else [[np.empty(0, np.int64)]] * len(names)
    return pa.table([pa.array(np.concatenate(list(c)).astype(np.int64)) for c in cols], names=names)


def met(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], cell: Callable, schema: str) -> DataFrame:
    """``cell(anchor block, row block)`` over all pairs of blocks."""
    dealt = lambda n: F.pmod(F.xxhash64("key_", "q"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    renamed = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own: both sides stem from one table
    left = renamed.withColumn("ab", dealt(blocks[0])).withColumn("rb", every(blocks[1]))
    right = rows.withColumn("rb", dealt(blocks[1])).withColumn("ab", every(blocks[0]))
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(cell, schema)


def mine(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each anchor (a condition on the key) and each of its ``positives`` best
    rows of the same label, the ``negatives`` best rows of other labels whose
    score lies between ``low`` and ``high`` percent of the positive's."""
    rows = usable(vectors, key, label, vector, scale)
    squares = F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x)
    held = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor(F.col("key_"))).alias("anchors"), F.max(squares).alias("norm")).first()
    norm = held["norm"] or 0.0
    if norm >= 2.0**50:
        raise ValueError(f"scores of up to {norm:g} are beyond the range of the residues")
    primes = primes_for(int(norm * 1.000001) + 1)  # |a . b| is at most the largest squared norm
    blocks = max(1, -(-held["anchors"] // ANCHORS)), max(1, -(-held["n"] // ROWS))

    once = rows.where(is_anchor(F.col("key_"))).groupBy("key_").agg(F.min(F.struct("label_", "q")).alias("r"))
    anchors = once.select("key_", "r.label_", "r.q")
    ids = "anchor_id long, positive_id long, positive_score long"
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (
        met(anchors, rows, blocks, lambda a, r: best_of_label(a, r, primes, positives), ids)
        .withColumn("place", F.row_number().over(best) - 1)
        .where(F.col("place") < positives)
    )
    found = written(found, "negatives-positives")
    scores = found.groupBy(F.col("anchor_id").alias("key_")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    windowed = anchors.join(scores, "key_").select("key_", "label_", "q", F.col("p.positive_score").alias("positives"))
    ids = "anchor_id long, place long, negative_id long, negative_score long"
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    return (
        met(windowed, rows, blocks, lambda a, r: best_in_windows(a, r, primes, negatives, low, high), ids)
        .withColumn("rank", rank)
        .where(F.col("rank") <= negatives)
        .join(found, ["anchor_id", "place"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
