"""Incremental line dedup: the filter, the counts, and that deletions undo inserts."""

import random
import re

import numpy as np
import pytest

from cairn.llm import linededup
from cairn.llm.linededup import NO_ID, CuckooFilter, LineIndex

SCHEMA = "doc_id long, text string, kept int, owner string, batch double"
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def key(line):
    k = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(LOWER)
    return k if len(k) >= 10 else None


def brute(rows, held=None):
    """(doc_id, kept, lines, dropped) of ``rows``; owners among ``held``."""
    order = lambda i: NO_ID if i is None else i
    owner = {}
    for i, text in rows if held is None else held:
        for k in filter(None, map(key, (text or "").split("\n"))):
            owner[k] = min(owner.get(k, NO_ID), order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) is None or owner.get(key(x), order(i)) >= order(i)]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA).repartition(3)


def kept(index, docs):
    return sorted((tuple(r) for r in index.kept(docs).collect()), key=str)


def state(index):
    """Counts and, by shard, how many keys the filters hold; every key is found."""
    counts = sorted(tuple(r) for r in index.counts().collect())
    shards = index._commits()[max(index._commits())][0]
    held = {r.shard: CuckooFilter.loaded(r.slots, r.rest) for r in index.filters(shards).collect()}
    assert sum(map(len, held.values())) == len(counts)
    for hi, lo, _, _ in counts:
        assert held[(hi % 2**64) >> (64 - shards.bit_length() + 1)].has(np.array([lo])).all()
    return counts


def some_rows():
    rng = random.Random(6)
    lines = [f"shared line number {k}" for k in range(30)] + ["short", "", "   ", "ünïcödé é", "ünïcödé éa", "x" * 10, "Boilerplate   "]
    rows = [(k * 3, "\n".join(rng.choices(lines, k=rng.randint(0, 8)) + [f"own line of {k}"] * rng.randint(0, 2))) for k in range(120)]
    rows += [(k, "the very common line\n\tThe Very Common Line  \nthe very common line ") for k in range(1000, 1200)]
    rows += [(5, None), (6, ""), (7, "\n"), (9, "own line of 3\r\nshared line number 1\r"), (9, "twice the same id here"), (9, "twice the same id here")]
    rows += [(None, "the very common line\nonly without an id"), (None, "only without an id\nshort"), (None, "only without an id\nshort"), (NO_ID, "only without an id")]
    return rows + [(8, "\n".join(f"a long document's line {k % 700}" for k in range(5000))), (2, "a long document's line 699")]


# ---------------------------------------------------------------- filter
@pytest.mark.parametrize("n", [0, 1, 3000, 4000])
def test_filter_holds_what_was_added(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(2**62), 2**62, n)
    f = CuckooFilter(buckets=1024)  # 4096 slots, up to 98 % full
    f.add(keys)
    assert len(f) == n and f.has(keys).all()
    f = CuckooFilter.loaded(*f.stored())
    others = rng.integers(-(2**62), 2**62, 50_000)
    assert f.has(others).mean() < 0.001
    f.remove(keys[: n // 2])
    assert len(f) == n - n // 2 and f.has(keys[n // 2 :]).all()
    assert n < 3000 or f.has(keys[: n // 2]).mean() < 0.01
    f.remove(keys[n // 2 :])
    assert len(f) == 0 and not f.slots.any()


def test_filter_beyond_its_slots_and_equal_keys():
    keys = np.r_[np.arange(700), np.full(40, 12345)]
    f = CuckooFilter(buckets=128)
    f.add(keys)
    assert len(f) == 740 and len(f.rest) >= 228 and f.has(keys).all()
    f.remove(np.full(39, 12345))
    assert f.has(np.array([12345])).all()
    f.remove(keys[:700])
    f.remove(np.array([12345]))
    assert len(f) == 0
    with pytest.raises(KeyError):
        f.remove(np.array([1]))


# ---------------------------------------------------------------- index
def test_one_batch_equals_brute_force(spark, scratch):
    rows = some_rows()
    index = LineIndex(spark, f"{scratch}/one")
    index.insert(frame(spark, rows))
    assert kept(index, frame(spark, rows)) == brute(rows)
    assert len(state(index)) == len({k for _, t in rows for k in map(key, (t or "").split("\n")) if k})


def test_batches_and_deletions_undo_each_other(spark, scratch, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 8)  # shards double on the way
    monkeypatch.setattr(linededup, "HOT", 20)
    rows = some_rows()
    a, b, c = rows[::3], rows[1::3], rows[2::3]
    index, plain = LineIndex(spark, f"{scratch}/many"), LineIndex(spark, f"{scratch}/plain")
    index.insert(frame(spark, a))
    index.insert(frame(spark, b))
    assert index._commits()[2][0] > index._commits()[1][0]
    assert kept(index, frame(spark, b)) == brute(b, a + b)
    out = {i for i, _ in b}
    index.delete(frame(spark, b + [(10**9, "not there")]))
    left = [r for r in a if r[0] not in out]
    plain.insert(frame(spark, left))
    assert state(index) == state(plain)  # as if b had never come
    assert kept(index, frame(spark, left)) == brute(left)
    index.insert(frame(spark, c))
    index.insert(frame(spark, b))  # deleted ids come back
    held = left + c + b
    assert kept(index, frame(spark, held)) == brute(held)
    state(index)
    index.delete(frame(spark, held))
    assert index.counts().count() == 0 and state(index) == []


def test_a_lost_batch_is_written_again(spark, scratch, monkeypatch):
    rows = some_rows()
    index = LineIndex(spark, f"{scratch}/lost")
    index.insert(frame(spark, rows[:100]))
    before = state(index)

    def lost(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(index, "_commit", lost)
    for change in (index.insert, index.delete):
        with pytest.raises(RuntimeError):
            change(frame(spark, rows[50:]))
        assert state(index) == before
    monkeypatch.undo()
    assert index.insert(frame(spark, rows[100:])) == 2
    assert kept(index, frame(spark, rows)) == brute(rows)


def test_empty_tables(spark, scratch):
    index = LineIndex(spark, f"{scratch}/empty")
    empty = spark.createDataFrame([], SCHEMA)
    index.insert(empty)
    assert kept(index, empty) == [] and index.counts().count() == 0
    index.delete(empty)
    index.insert(frame(spark, [(1, "a line to be kept"), (2, "a line to be kept")]))
    assert kept(index, frame(spark, [(2, "a line to be kept"), (1, "a line to be kept")])) == [(1, "a line to be kept", 1, 0), (2, "", 1, 1)]
    assert kept(index, frame(spark, [(7, "never inserted text")])) == [(7, "never inserted text", 1, 0)]
