"""Toxicity network: gradients, windows, and held-out accuracy."""

import random

import numpy as np

from cairn.llm import toxicity as tox


def corpus(n, seed=1, longest=200):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["tha", "on", "er", "ti", "re", "sh"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(1, longest))]
        if k % 4 == 0:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["zorg", "quaxi", "blig" + rng.choice(["eh", "uv", "ox"]) + word()]))
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    return rows


def lists(rows):
    return [[w for part in tox.words_of(t) for w in part] for _, t, _ in rows]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = tox.new_network(lists(corpus(60)), np.array([y for *_, y in corpus(60)], float), rng)
    for name in net.w:
        net.w[name] = net.w[name].astype(np.float64)
    x = rng.normal(0, 1, (9, 2 * tox.WIDE))
    at = rng.integers(0, 9, (4, 7))
    live = np.arange(7) < np.array([7, 3, 1, 5])[:, None]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def loss():
        gates = x @ net.w["into"] + net.w["into_bias"]
        z = net.pooled(net.states(gates, at, live).astype(np.float64), live)[0][:, 0]
        return float((weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum() / weight.sum())

    grads, by_input = tox.gradients(net, x, at, live, y, weight)
    for name, grad in grads.items():
        flat = net.w[name].reshape(-1)
        for k in rng.choice(flat.size, min(5, flat.size), replace=False):
            old, step = flat[k], 1e-3
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert abs((up - down) / (2 * step) - grad.reshape(-1)[k]) < 2e-3, name


def test_windows_cover_all_words():
    for n in range(0, 200):
        starts = tox.window_starts(n)
        seen = {k for s in starts for k in range(s, min(n, s + tox.WINDOW))}
        assert seen == set(range(n))
        assert all(s < n for s in starts)


def test_words_of_long_texts_come_in_parts():
    text = "Wörd, x-y! " * 3000
    whole = [w for part in tox.words_of(text) for w in part]
    assert [w for part in tox.words_of(text, step=100) for w in part] == whole
    assert whole[:3] == ["wörd".encode(), b"x", b"y"]


def test_held_out_accuracy_and_scores(spark, monkeypatch):
    rows = corpus(700)
    docs = spark.createDataFrame([(*r, "x", None) for r in rows], "doc_id long, text string, toxic int, score string, y double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1)], "doc_id long, toxic int")
    net = tox.fit(docs, labels, held_out=lambda key: key >= 500)
    got = {r.doc_id: r for r in tox.score(docs, net).collect()}
    held = rows[500:]
    assert sum(got[i].predicted == y for i, _, y in held) >= 0.95 * len(held)
    # a text's score is that of its highest window, whatever the batch and the words known
    monkeypatch.setattr(tox, "AT_ONCE", 50)
    monkeypatch.setattr(tox, "KNOWN_WORDS", 20)
    again = tox.Scorer(net).scores([t for _, t, _ in held])
    assert np.allclose(again, [got[i].score for i, _, _ in held], atol=1e-5)
    for i, t, _ in held[:20]:
        words = [w for part in tox.words_of(t) for w in part]
        best = max(tox.Scorer(net).logits([b" ".join(words[s : s + tox.WINDOW]).decode()])[0] for s in tox.window_starts(len(words)))
        assert abs(net.probability(best) - got[i].score) < 1e-4
    kept = tox.keep_clean(docs, net)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.score < 0.5}
    # long texts: one toxic word far behind a clean start
    clean = " ".join(t for _, t, y in rows[1:40] if not y) + " "
    low, high = tox.Scorer(net).scores([clean * 20, clean * 20 + "zorg quaxi " + clean])
    assert low < 0.5 <= high


def test_rows_of_every_kind(spark):
    docs = spark.createDataFrame([(1, None), (1, ""), (None, "!!! ---"), (2, "fine words"), (2, "fine words")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.fit(docs, none) is None and tox.fit(docs, spark.createDataFrame([(2, 0)], none.schema)) is None
    assert [(r.score, r.predicted) for r in tox.score(docs, None).collect()] == [(0.0, 0)] * 5
    rows = corpus(80, longest=30)
    net = tox.train(lists(rows), np.array([y for *_, y in rows], float))
    got = tox.score(docs, net).collect()
    assert len(got) == 5 and all(0 <= r.score <= 0.49 for r in got[:3]) and got[3].score == got[4].score
    assert tox.score(docs.limit(0), net).count() == 0
