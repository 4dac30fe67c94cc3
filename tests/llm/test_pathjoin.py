"""Chosen-path join against all pairs."""

import random
from collections import Counter, defaultdict

import pytest

from cairn.llm import pathjoin


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    near = lambda base, share: " ".join(rng.choice(words) if rng.random() < share else w for w in base)
    texts = []
    for _ in range(20):
        base = [rng.choice(words) for _ in range(rng.choice([3, 12, 60, 200]))]
        texts += [near(base, rng.choice([0, 0.005, 0.01, 0.02])) for _ in range(rng.choice([1, 2, 5, 20]))]
    hot = [rng.choice(words) for _ in range(150)]
    texts += [near(hot, 0.008) for _ in range(150)] + [" ".join(hot)] * 40 + [None, None, "", " ", "a b", "a b", "a  b", "x " * 30_000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5]), (None, "zz yy xx")]
    rng.shuffle(rows)
    return rows


def brute(rows):
    texts = defaultdict(list)
    for i, t in rows:
        texts[t].append(i)
    keys = list(texts)
    split = [(t or "").encode().split() for t in keys]
    sets = [{tuple(w[k : k + min(5, len(w))]) for k in range(len(w) - min(5, len(w)) + 1)} if w else set() for w in split]
    parent, links = list(range(len(keys))), Counter()

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(keys)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    members = defaultdict(list)
    for i, t in enumerate(keys):
        members[top(i)] += [x for x in texts[t] if x is not None]
    out, stay = Counter(), 0
    for i, t in enumerate(keys):
        for doc in texts[t]:
            lead = min(members[top(i)], default=None) if sets[i] else doc
            out[(doc, lead, links[i], len(texts[t]) if sets[i] else 1)] += 1
        stay += (top(i) == i) if sets[i] else len(texts[t])
    return out, stay


@pytest.mark.parametrize("limit", [1000, 25])
def test_classes_and_links_equal_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(pathjoin, "LIMIT", limit)  # a small limit splits buckets and compares them in blocks
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, path int, key string").repartition(4)
    want, stay = brute(rows)
    assert Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in pathjoin.near_duplicates(docs).collect()) == want
    if limit == 1000:
        kept = pathjoin.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == stay


def test_rows_that_repeat_a_text_and_its_id(spark):
    """Hot keys: one text under no id, one under ids of its own, rows without words."""
    text = "the same words again and again and again"
    rows = [(None, text, {"n": "2"}, "b", 1)] * 300 + [(None, text, {"n": "1"}, "b", 2)] * 300 + [(k, "other text of some length here", {}, "a", k) for k in range(300)]
    rows += [(7, None, {}, None, 0)] * 300 + [(8000 + k, f"w{k} x y z", {}, "c", k) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,string>, key string, row int").repartition(4)
    got = Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in pathjoin.near_duplicates(docs).collect())
    want = Counter({(None, None, 0, 600): 600, (7, 7, 0, 1): 300})
    want.update({(k, 0, 0, 300): 1 for k in range(300)})
    want.update({(8000 + k, 8000 + k, 0, 1): 1 for k in range(100)})
    assert got == want
    kept = pathjoin.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    kept = [(r.doc_id, r.text, r.m, r.key, r.row) for r in kept.collect()]
    assert [r for r in kept if r[1] == text] == [(None, text, {"n": "1"}, "b", 2)]  # maps decide, here before the row
    assert [r[:1] + r[3:] for r in kept if r[1] and r[1].startswith("other")] == [(0, "a", 0)]
    assert len(kept) == 1 + 1 + 300 + 100


@pytest.mark.parametrize("members", [300, 900])
def test_a_group_of_near_copies_costs_its_members(spark, monkeypatch, members):
    """One page with a number of its own in each copy, some copies changed more."""
    monkeypatch.setattr(pathjoin, "LIMIT", 30)
    rng = random.Random(members)
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join([*base[:90], f"n{k}", *base[90:]]) for k in range(members)]
    for k in range(8):  # too far for the core, linked to some of it or to none
        texts.append(" ".join(w if rng.random() > 0.01 + 0.005 * k else "changed" for w in base))
    texts += ["a b c d e f g", "a b c d e f g h", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    dealt = []
    paired = pathjoin.paired
    monkeypatch.setattr(pathjoin, "paired", lambda entries: dealt.append((entries.count(), paired(entries).count())) or paired(entries))
    got = Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in pathjoin.near_duplicates(docs).collect())
    assert got == brute(list(enumerate(texts)))[0]
    assert sum(n >= members - 1 for _, _, n, _ in got) >= members
    # each entry of the core meets the few blocks of others, not all of the core's own
    assert all(rows <= 2 * entries + 1000 for entries, rows in dealt), dealt


@pytest.mark.parametrize("share", [1e-3, 0.2])
def test_hot_keys_are_joined_as_others(spark, monkeypatch, share):
    monkeypatch.setattr(pathjoin, "HOT", share)
    rows = pathjoin.written(spark.createDataFrame([(k % 3 if k < 150 else k, k) for k in range(300)], "key long, v long"), "test-rows")
    table = pathjoin.written(spark.createDataFrame([(k, -k) for k in range(280)], "key long, w long"), "test-table")
    got = pathjoin.hot_join(rows, table, "key")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(table, "key").collect()))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pathjoin.near_duplicates(docs).count() == 0
    docs = spark.createDataFrame([(1, None), (1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in pathjoin.near_duplicates(docs).collect()) == [(1, 1, 0, 1), (1, 1, 0, 1), (2, 2, 0, 1)]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 90), (90, 95)], "a long, b long")
    got = {r.node: r.label for r in pathjoin.components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


def test_runs_reach_the_recall():
    assert pathjoin.runs_for(0.9999, 0.8) >= 4
    assert pathjoin.runs_for(0.9, 0.8) < pathjoin.runs_for(0.99999, 0.8)
    assert pathjoin.agreement_for(0.8) < 0.8 * pathjoin.COORDINATES
