"""Hard negatives against plain Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, place int, q double"


def brute(rows, low=30, high=90, positives=5, negatives=10):
    good = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a in sorted({i for i, _, _ in good if i % 100 == 0}):
        label, v = min((lab, w) for i, lab, w in good if i == a)
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in good if i != a and len(w) == len(v))
        for ps, p, _ in [x for x in scored if x[2] == label][:positives]:
            held = [x for x in scored if x[2] != label and low * -ps <= 100 * -x[0] <= high * -ps][:negatives]
            out += [(a, p, r, i, -ps, -s) for r, (s, i, _) in enumerate(held, 1)]
    return sorted(out)


def mined(spark, rows, **how):
    table = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(3)
    df = hardneg.mine(table, lambda key: key % 100 == 0, F.col("label"), **how)
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert dict(df.dtypes)["rank"] == "int"
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("size,dims", [(5, 7), (400, 64), (40_000, 65), (3_000_000, 200)])
def test_residue_products_are_exact(size, dims):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size + 1, (20, dims)), rng.integers(-size, size + 1, (30, dims))
    b[0], b[1] = a[0], -a[0]  # the extremes of both signs
    bound = int(max((a * a).sum(axis=1).max(), (b * b).sum(axis=1).max()))
    primes = hardneg.primes_for(bound)
    assert math.prod(primes) > 2 * bound and len(set(primes)) == len(primes)
    got = hardneg.Factor(a.astype(float), primes).scores(hardneg.Factor(b.astype(float), primes))
    assert (got == a @ b.T).all()
    assert all((abs(hardneg.residues(a.astype(float), p)) <= 511).all() for p in primes)


def test_equals_brute_force_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ANCHORS", 3)
    monkeypatch.setattr(hardneg, "ROWS", 60)
    rng = random.Random(4)
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = []
    for k in range(600):
        c = rng.choice(centre)
        rows.append((k * 20, [round(x + rng.gauss(0, 0.6), 1) for x in c], rng.randint(0, 3)))
    crowd = rows[0][1]
    rows += [(k, list(crowd), 1) for k in range(20_001, 20_120)]  # ties beyond every limit
    rows += [(100, rows[7][1], 0), (100, rows[8][1], 2), (140, rows[9][1], 1), (140, rows[9][1], 1)]  # repeated ids
    rows += [(None, crowd, 1), (30_000, None, 1), (30_100, [], 1), (30_200, [None] * 6, 1), (30_300, [math.nan] * 6, 1)]
    rows += [(30_400, [math.inf] * 6, 1), (30_500, crowd, None), (30_600, [1.0, 2.0], 1), (30_601, [1.0, 1.5], 1), (30_602, [1.0, 1.0], 2)]
    rows += [(30_700, [0.0] * 6, 1), (30_800, [-1.0] * 6, 9), (30_801, [1.0] * 6, 9)]  # zero scores; a negative positive
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, low=0, high=50, positives=2, negatives=3) == brute(rows, 0, 50, 2, 3)


def test_empty_and_out_of_range(spark):
    assert mined(spark, []) == [] == mined(spark, [(1, [1.0], 2)]) == mined(spark, [(100, [1.0], 2)])
    with pytest.raises(ValueError, match="beyond the range"):
        mined(spark, [(100, [1e9], 2), (101, [1e9], 2)])
