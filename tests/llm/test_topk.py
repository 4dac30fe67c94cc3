"""Exact top-k against a full product."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import topk


def brute(qid, q, cid, c, k):
    out = []
    for row, vector in zip(qid, q):
        scores = sorted((-int(vector @ x), int(i)) for i, x in zip(cid, c) if i != row)
        out.append([(i, -s) for s, i in scores[:k]])
    return out


@pytest.mark.parametrize("n,dims,spread", [(1, 4, 5), (30, 8, 5), (3000, 16, 20), (3000, 6, 1)])
def test_block_equals_full_product(n, dims, spread):
    rng = np.random.default_rng(n + spread)
    c = rng.integers(-spread, spread + 1, (n, dims)).astype(float)
    c[n // 2 :: 3] = c[0]  # a third of the rows alike: ties everywhere
    cid = rng.permutation(n * 2)[:n]
    rows = rng.choice(n, min(n, 40), replace=False)
    got = [[] for _ in rows]
    for row, vec, score in zip(*topk.block_topk(cid[rows], c[rows], cid, c, 20)):
        got[row].append((int(vec), int(score)))
    got = [sorted(g, key=lambda x: (-x[1], x[0])) for g in got]
    assert got == brute(cid[rows], c[rows], cid, c, 20)


def share_left(q, own, c, k=20):
    places = np.argsort(np.argsort(c, axis=0, kind="stable"), axis=0, kind="stable")
    left, _, read = topk.candidates_left(q, own, c, places, np.sort(c, axis=0), k)
    return left.sum() / left.size, read.mean()


def test_reading_stops_early():
    """One strong match a query: bounds settle at the first depth."""
    rng = np.random.default_rng(5)
    c = rng.normal(0, 1, (4000, 4)).round()
    q = np.array([[50.0, 0, 0, 0]])
    c[:30, 0] = 200
    share, read = share_left(q, np.zeros((1, 4000), bool), c)
    assert share * 4000 <= 30 and read <= 0.55
    rows, ids, scores = topk.block_topk(np.array([-1]), q, np.arange(4000), c, 20)
    assert sorted(ids.tolist()) == list(range(20)) and set(scores.tolist()) == {10_000}


def test_few_candidates_of_the_given_vectors_are_scored(spark):
    """At every size the bounds decide: no more than FEW of the candidates get a
    final score, and part of the lists is never read."""
    for sf in ("sf0.01", "sf0.1"):
        got = topk.quantised(spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")).toPandas()
        c, ids = np.array(got["q"].tolist(), float), got["key_"].to_numpy()
        some = ids % 20 == 0
        share, read = share_left(c[some], ids[None, :] == ids[some][:, None], c)
        assert share <= max(topk.FEW, 20 / len(c)) + 1e-9 and read < 1, (sf, share, read)


def test_table_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rng = np.random.default_rng(7)
    rows = [(int(k), [float(x) for x in rng.normal(0, 0.2, 5)]) for k in range(200)]
    rows += [(k, list(rows[0][1])) for k in range(200, 260)] + [(40, rows[1][1]), (300, None), (320, []), (None, rows[2][1])]
    rows += [(340, [math.nan] * 5), (360, [math.inf] + [0.0] * 4), (380, [None] + [0.0] * 4), (400, [1.0, 2.0])]
    table = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    got = {}
    for r in topk.top_k(table, lambda key: key % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    good = [(k, [math.floor(64 * float(np.float32(x))) for x in v]) for k, v in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = {}
    for k in sorted({k for k, v in good if k % 20 == 0}):
        v = min(v for i, v in good if i == k)
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != k and len(w) == len(v))
        if scores:
            want[k] = [(i, -s, n) for n, (s, i) in enumerate(scores[:20], 1)]
    assert got == want
    assert topk.top_k(table.where(F.lit(False)), lambda key: key % 20 == 0).count() == 0
