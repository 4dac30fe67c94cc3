"""Packing documents into fixed-length sequences by cutting-stock column
generation.

Every document is encoded, closed with id 0 and cut: full pieces of
``capacity`` ids, then the powers of two from ``SMALLEST_PART`` on that make up
the rest, then one tail below ``SMALLEST_PART``. So whatever lengths a corpus
repeats (thousands of copies of one awkward length, say), its pieces can fill
sequences without gaps, and the program below stays small. Only the histogram
of piece lengths (about ``SMALLEST_PART`` rows, whatever the corpus) reaches the
driver.
There a linear program over filling patterns is solved: the master holds the
patterns found so far, an unbounded-knapsack dynamic program over the dual
prices makes the next ones, until the bound says that no pattern can save
more than ``GAP``. Patterns are used as often as the rounded solution says;
what rounding leaves (a number of pieces that depends on ``capacity`` only) is
packed by exact subset sums. Pieces are then ranked within their length and
look up their place by rank, so placing is one narrow shuffle and no join
against the plan's size.

Defined results: null and empty texts are the single id 0, one piece. Each
row is a document of its own, also if it repeats another row or its id. Ties
in rank go by doc_id, start and checksum; rows equal in all of them are
interchangeable. An empty table gives an empty result. Extra columns of the
input are ignored. A sequence whose length is a power of two needs no padding,
others are padded to ``capacity``.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import coder, share_vocabulary
from .common import column, prepare, written

CAPACITY = 1024
#: Rests are cut at powers of two down to this length.
SMALLEST_PART = 128
#: The master stops when its value is within this share of the lower bound.
GAP = 5e-4
MAX_PIVOTS = 4000
#: Pieces that one rank bucket of a length holds on average.
BUCKET_ROWS = 50_000


def cuts(tokens: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of that many ids."""
    out = [(at, capacity) for at in range(0, tokens - capacity + 1, capacity)]
    at, part = len(out) * capacity, 1 << (capacity - 1).bit_length()
    while at < tokens:
        part = part >> 1 if part > SMALLEST_PART else tokens - at
        if tokens - at >= part:
            out.append((at, part))
            at += part
    return out


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Cut every document: one row per piece, in document order."""
    import pyarrow as pa

    prepare(docs.sparkSession)
    spec = share_vocabulary(docs.sparkSession, vocabulary)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        bpe = coder(spec.value, by_library=True)
        for batch in batches:
            out = {name: [] for name in names}
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                raw = memoryview(bpe.encode(text) + bytes(4))
                n = len(raw) // 4
                for start, length in cuts(n, capacity):
                    part = raw[4 * start : 4 * (start + length)]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(n)
                    if with_ids:
                        out["ids"].append(bytes(part))
            types = [pa.binary() if name == "ids" else pa.int64() for name in names]
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


# ------------------------------------------------------------ the plan
def best_fills(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack: the value of each capacity and the length taken
    last there (-1: one unit stays empty)."""
    value = np.zeros(capacity + 1)
    taken = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        fit = np.searchsorted(lengths, c, side="right")
        if fit:
            gains = value[c - lengths[:fit]] + prices[:fit]
            k = int(gains.argmax())
            if gains[k] > value[c] + 1e-12:
                value[c], taken[c] = gains[k], k
    return value, taken


def filled(taken: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    pattern = np.zeros(len(lengths))
    c = capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= lengths[taken[c]]
    return pattern


def solve_master(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Column generation. Returns (pattern, times used) with ``times`` real.

    The first basis pairs a length with its complement where both occur, and
    repeats a length for what is left of it; it is triangular and feasible.
    """
    m = len(lengths)
    at = {int(v): k for k, v in enumerate(lengths)}
    basis, inverse = np.zeros((m, m)), np.zeros((m, m))
    used = np.zeros(m)
    cost = np.ones(m)
    for k, v in enumerate(lengths):
        basis[k, k] = capacity // v
        inverse[k, k] = 1 / basis[k, k]
        used[k] = demand[k] / basis[k, k]
    for k, v in enumerate(lengths):
        j = at.get(int(capacity - v))
        if j is not None and j != k and (demand[k], k) < (demand[j], j):
            basis[:, k] = 0
            basis[k, k] = basis[j, k] = inverse[k, k] = 1
            inverse[j, k] = -inverse[j, j]  # column j keeps its diagonal only
            used[k] = demand[k]
            used[j] = (demand[j] - demand[k]) / (capacity // lengths[j])
    bound = float(demand @ lengths) / capacity
    pivots = 0
    while pivots < MAX_PIVOTS:
        prices = cost @ inverse
        value, taken = best_fills(lengths, np.maximum(prices, 0), capacity)
        bound = max(bound, float(np.maximum(prices, 0) @ demand) / max(value[capacity], 1.0))
        if cost @ used <= bound * (1 + GAP):
            break
        # one program prices many patterns: the best one with each length forced in
        gain = prices + value[capacity - lengths]
        entering = []
        for k in np.argsort(-gain)[:40]:
            if gain[k] > 1 + 1e-7:
                pattern = filled(taken, lengths, int(capacity - lengths[k]))
                pattern[k] += 1
                entering.append((pattern, 1.0))
        worst = int(prices.argmin())
        if prices[worst] < -1e-9:
            slack = np.zeros(m)
            slack[worst] = -1
            entering.append((slack, 0.0))
        moved = False
        for pattern, price in entering:
            if prices @ pattern <= price + 1e-7:
                continue
            step = inverse @ pattern
            rows = np.flatnonzero(step > 1e-9)
            if not len(rows):
                continue
            ratio = used[rows] / step[rows]
            r = rows[int(ratio.argmin())]
            theta = max(0.0, float(used[r] / step[r]))
            used = np.maximum(used - theta * step, 0)
            used[r] = theta
            basis[:, r], cost[r] = pattern, price
            row = inverse[r] / step[r]
            nonzero = np.flatnonzero(np.abs(step) > 1e-13)
            inverse[nonzero] -= np.outer(step[nonzero], row)
            inverse[r] = row
            prices = cost @ inverse
            moved, pivots = True, pivots + 1
        if not moved:
            break
    return [(basis[:, k], float(used[k])) for k in range(m) if cost[k] and used[k] > 1e-9]


def fill_exactly(lengths: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """One sequence from the largest piece left and a subset of the others
    that fills it best: to ``capacity``, else to a power of two, else most."""
    first = int(np.flatnonzero(left)[-1])
    room = capacity - int(lengths[first])
    steps, reach, mask = [], 1, (1 << (room + 1)) - 1
    for k in np.flatnonzero(left)[::-1]:
        n = int(left[k]) - (k == first)
        for _ in range(min(n, room // int(lengths[k]))):
            steps.append((int(k), reach))
            reach |= (reach << int(lengths[k])) & mask
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    if total < room:
        exact = [p - int(lengths[first]) for p in (1 << b for b in range(capacity.bit_length())) if p >= lengths[first]]
        total = next((t for t in reversed(exact) if t <= room and reach >> t & 1), total)
    out = {first: 1}
    for k, before in reversed(steps):
        if not before >> total & 1:  # this piece is what reaches the total
            out[k] = out.get(k, 0) + 1
            total -= int(lengths[k])
    return out


def cutting_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(pattern as {length: pieces}, number of sequences) covering exactly
    ``counts``."""
    plan = [({capacity: 1}, counts[capacity])] if counts.get(capacity) else []
    rest = {v: n for v, n in counts.items() if v < capacity and n}
    if not rest:
        return plan
    lengths = np.array(sorted(rest), dtype=np.int64)
    left = np.array([rest[int(v)] for v in lengths], dtype=np.int64)
    for pattern, times in sorted(solve_master(lengths, left.astype(float), capacity), key=lambda p: -(p[0] @ lengths)):
        ks = np.flatnonzero(pattern)
        n = int(min(np.floor(times + 1e-6), (left[ks] // pattern[ks].astype(np.int64)).min()))
        if n > 0:
            left[ks] -= n * pattern[ks].astype(np.int64)
            plan.append(({int(lengths[k]): int(pattern[k]) for k in ks}, n))
    while left.any():
        chosen = fill_exactly(lengths, left, capacity)
        n = int(min(left[k] // c for k, c in chosen.items()))
        for k, c in chosen.items():
            left[k] -= n * c
        plan.append(({int(lengths[k]): c for k, c in chosen.items()}, n))
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, offset, filled),
    sorted: the pieces of a length from that rank on go there."""
    rows, taken, sequence = [], {}, 0
    for pattern, n in plan:
        offset, total = 0, sum(v * k for v, k in pattern.items())
        for v in sorted(pattern, reverse=True):
            rows.append((v, taken.get(v, 0), pattern[v], sequence, offset, total))
            taken[v] = taken.get(v, 0) + n * pattern[v]
            offset += v * pattern[v]
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def dealt_buckets(cut: DataFrame, total: int) -> DataFrame:
    """Pieces of a written table with their ``bucket``. The place in the table
    parts pieces that are alike in every column."""
    buckets = max(16, -(-total // BUCKET_ROWS))
    dealt = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", F.col("_metadata.row_index"))
    return cut.withColumn("bucket", F.pmod(dealt, F.lit(buckets)))


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """``place_rank``: the number of a piece among those of its length, from 0.

    A length may hold most pieces, so each is dealt into buckets; ranks count
    within a bucket, behind the pieces of the buckets before it."""
    cut = dealt_buckets(cut, total)
    sizes = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    return (
        cut.withColumn("inside", F.row_number().over(inside))
        .join(base, ["length", "bucket"])
        .withColumn("place_rank", F.col("base") + F.col("inside") - 1)
        .drop("bucket", "base", "inside")
    )


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and offset; ``sequence_tokens`` is
    the number of ids in the whole sequence. ``with_ids`` keeps the ids."""
    import pyarrow as pa

    cut = written(pieces(docs, capacity, vocabulary, with_ids), "pack-pieces")
    counts = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(cutting_plan(counts, capacity))
    keys = where[:, 0] << np.int64(40) | where[:, 1]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    added = ["sequence_id", "offset", "sequence_tokens"]
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in [*names, *added])

    def place(batches):
        for batch in batches:
            cols = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
            length, rank = cols["length"].to_numpy(zero_copy_only=False), cols["place_rank"].to_numpy(zero_copy_only=False)
            hit = where[np.searchsorted(keys, length << np.int64(40) | rank, side="right") - 1]
            copy, slot = np.divmod(rank - hit[:, 1], hit[:, 2])
            made = [hit[:, 3] + copy, hit[:, 4] + slot * length, hit[:, 5]]
            yield pa.RecordBatch.from_arrays([cols[n] for n in names] + [pa.array(x, pa.int64()) for x in made], names=[*names, *added])

    return ranked(cut, sum(counts.values())).mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: at most ``capacity`` ids each, in order. Takes the
    result of ``pack(..., with_ids=True)``; ids are little-endian 32-bit."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["offset"].alias("offset"))).alias("members"),
        F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
    )
