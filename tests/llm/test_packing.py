"""Packing: every id once, in gapless sequences, with little padding."""

import os
import random
import subprocess
import sys
import zlib
from array import array
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from cairn.llm import bpe, packing


def padding(plan, capacity=packing.CAPACITY):
    """(padded ids, ids); a power of two needs none."""
    empty = used = 0
    for pattern, n in plan:
        total = sum(v * k for v, k in pattern.items())
        assert 0 < total <= capacity
        used += total * n
        empty += (capacity - total) * n if total & (total - 1) else 0
    return empty, used


def test_cuts_cover_a_document():
    for n in range(1, 3000):
        cuts = packing.cuts(n)
        assert cuts[0][0] == 0 and sum(size for _, size in cuts) == n
        assert all(a + size == b for (a, size), (b, _) in zip(cuts, cuts[1:]))
        assert all(0 < size <= packing.CAPACITY for _, size in cuts)


def test_plans_cover_the_histogram_with_little_padding():
    rng = np.random.default_rng(1)
    for n, copies, most in ((0, 0, 1), (300, 0, 0.03), (5000, 0, 0.002), (5000, 4000, 0.002)):
        counts = defaultdict(int)
        for k, tokens in enumerate(rng.integers(1, 3000, n).tolist()):
            for _, size in packing.cuts(700 if k < copies else tokens):
                counts[size] += 1
        plan = packing.cutting_plan(counts)
        got = defaultdict(int)
        for pattern, times in plan:
            for v, k in pattern.items():
                got[v] += k * times
        assert got == counts
        empty, used = padding(plan)
        assert empty <= most * max(used, 1)


def test_master_reaches_the_material_bound():
    lengths, demand = np.array([300, 400, 500, 624]), np.array([90.0, 60.0, 70.0, 60.0])
    solved = packing.solve_master(lengths, demand, 1024)
    covered = sum(pattern * times for pattern, times in solved)
    assert (covered >= demand - 1e-6).all()
    # 624 + 400 fills a sequence; 500 + 500 and three 300 fill the others
    assert sum(times for _, times in solved) <= 60 + 35 + 30 + 1e-6


def test_first_basis_is_inverted_right():
    """Complements, equal demands and lengths without a partner, by hand and
    against the material bound (no pivot starts from a wrong inverse)."""
    lengths, demand = np.array([100, 512, 600, 924]), np.array([7.0, 9.0, 5.0, 7.0])
    covered = sum(pattern * times for pattern, times in packing.solve_master(lengths, demand, 1024))
    assert (covered >= demand - 1e-6).all()


FRESH = """
import numpy as np
from cairn.session import build_session
from cairn.llm import packing
spark = build_session(master="local[2]", app="fresh")
spark.range(10).count()
counts = {int(v): int(n) for v, n in zip(range(1, 1025, 3), np.random.default_rng(0).integers(1, 500, 400))}
print(len(packing.cutting_plan(counts)) > 0)
spark.stop()
"""


def test_plan_after_a_session_has_started():
    """In a process of its own, without any thread setting: no library call may
    wait for threads that were lost when the session started the JVM."""
    env = {k: v for k, v in os.environ.items() if not k.endswith("_NUM_THREADS")}
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", FRESH], env=env | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("True"), done.stderr[-2000:]


def test_pieces_alike_in_every_column_spread(spark, tmp_path):
    """Null ids and one text: no bucket gets all of them."""
    rows = [(None, "one and the same text")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    cut = packing.written(packing.pieces(docs, 1024, None, False), "alike")
    sizes = packing.ranked(cut, 3000).groupBy("place_rank").count().collect()
    assert len(sizes) == 3000 and {r["count"] for r in sizes} == {1}
    assert packing.dealt_buckets(cut, 3000).groupBy("bucket").count().agg({"count": "max"}).first()[0] < 1000


def docs_of(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9)))
    texts = [" ".join(word() for _ in range(rng.choice([1, 20, 300, 2500]))) for _ in range(60)] + [None, "", "x y z"] + ["copy " * 400] * 40
    rows = [(k // 2, t) for k, t in enumerate(texts)] + [(None, "no id"), (3, texts[6])]
    return rows, spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, length long, sequence_id long").repartition(5)


def test_every_id_in_one_piece(spark):
    rows, docs = docs_of(spark)
    library = Tokenizer.from_file(bpe.default_vocabulary())
    ids = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    got = packing.pack(docs).collect()
    assert got[0].__fields__[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    # pieces by document (repeated rows give the pieces more than once)
    want = sorted(
        (-1 if i is None else i, at, size, zlib.crc32(array("I", x[at : at + size]).tobytes()), len(x)) for i, x in ids for at, size in packing.cuts(len(x))
    )
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    empty = used = 0
    for parts in by_sequence.values():
        parts.sort()
        ends = [a + n for a, n in parts]
        assert [a for a, _ in parts] == [0, *ends[:-1]] and ends[-1] <= 1024
        used += ends[-1]
        empty += 1024 - ends[-1] if ends[-1] & (ends[-1] - 1) else 0
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert empty <= 0.02 * used


def test_sequences_hold_the_ids(spark):
    rows, docs = docs_of(spark)
    whole = packing.sequences(packing.pack(docs, with_ids=True)).collect()
    total = sum(len(r.ids) // 4 for r in whole)
    library = Tokenizer.from_file(bpe.default_vocabulary())
    assert total == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert all(len(r.ids) <= 4096 for r in whole)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
