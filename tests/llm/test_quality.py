"""Quality rules: statistics by brute force, and the model's verdicts."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cairn.llm import quality
from cairn.llm.common import WordHashes, ascii_words


def slow_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    inside = {j for k, w in enumerate(windows) if w in often for j in range(k, k + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def statistics(text):
    words = ascii_words(text)
    return quality.statistics(text, words, quality.word_hashes(words, WordHashes()))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x0b\x1c\x85\xa0#|é　"), max_size=60))
def test_statistics_equal_brute_force(text):
    assert statistics(text) == slow_statistics(text)


def test_statistics_of_odd_texts():
    for text in (None, "", " \n", "a b c d e " * 4000, "x" * 100_000, "l\nl\n l\n\n\nl", "one two three four five six"):
        assert statistics(text) == slow_statistics(text)


def corpus(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["the", "an", "er", "on", "ti", "re"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(12, 120))]
        bad = k % 4 == 0
        if bad:
            words = [w + rng.choice(["$$$", "%%%", "&&&"]) for w in words] if k % 8 else [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words), 0 if bad else 1))
    return rows


def test_model_separates_labelled_rows(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, kept string, y string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:300]] + [(0, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    held = rows[300:]
    right = sum(got[i].kept == (bool(y) and not got[i].base_failed) for i, t, y in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= got[i].quality_score <= 1 for i, _, _ in rows)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_rows_of_every_kind(spark):
    rows = [(1, None), (1, ""), (2, "w " * 9), (None, " ".join(f"w{k}" for k in range(10))), (3, "a b c d e f " * 50), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.fit(docs, none) is None
    assert quality.fit(docs, spark.createDataFrame([(2, 1)], none.schema)) is None  # one class only
    got = sorted(((r.doc_id or -1), r.n_words, r.base_failed, r.kept) for r in quality.judge(docs, None).collect())
    assert got == [(-1, 10, False, True), (1, 0, True, False), (1, 0, True, False), (1, 0, True, False), (2, 9, True, False), (3, 300, True, False)]
    assert quality.judge(docs.limit(0), None).count() == 0


def test_platt_is_a_probability():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * z - 1)))).astype(float)
    slope, shift = quality.platt(z, y)
    assert abs(slope - 0.5) < 0.1 and abs(shift + 1) < 0.2


def test_labels_of_other_documents_leave_the_sample_full(spark):
    """A hundred labels for each document; long and null texts are replaced too."""
    docs = spark.range(300).selectExpr("id * 100 AS doc_id", "IF(id % 10 = 0, NULL, IF(id % 10 = 1, repeat('x ', 500), concat('text ', id))) AS text")
    labels = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    got = quality.sample(docs, labels, "quality", lambda key: key % 700 == 0, rows=150, chars=400).collect()
    assert len(got) == 150 and all(r.text.startswith("text ") and r.doc_id % 700 and r.doc_id % 100 == 0 for r in got)
    fewer = quality.sample(docs.union(docs), labels, "quality", lambda key: key < 0, rows=1000, chars=400).collect()
    assert len(fewer) == 240 and len({r.doc_id for r in fewer}) == 240


def slow_grams(text, words):
    families = [[(w,) for w in words], list(zip(words, words[1:]))]
    return families + [[text[k : k + n] for k in range(len(text) - n + 1)] for n in (1, 2, 3)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab é日😀\ud800 \n"), max_size=40))
def test_grams_are_of_words_and_characters(text):
    """As many as there are, equal buckets for equal ones, others mostly apart."""
    words = ascii_words(text)
    got = quality.grams(quality.characters(text), quality.word_hashes(words, WordHashes()))
    for buckets, want in zip(got, slow_grams(text, words)):
        assert len(buckets) == len(want) and all(0 <= b < quality.BUCKETS for b in buckets)
        assert len({(b, w) for b, w in zip(buckets.tolist(), want)}) == len(set(want))
