"""Rule ensemble: compiled rules, sparsity and held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from cairn.llm import rule_ensemble as rules
from test_quality import corpus


def test_fit_is_sparse_and_right_on_rows_not_seen():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (2000, len(rules.STATISTICS)))
    y = ((x[:, 2] > 0.3) & (x[:, 7] <= 0.5) | (x[:, 0] > 1.5)).astype(float)
    ensemble = rules.fit_rules(x[:1500], y[:1500])
    p = ensemble.score_matrix(x[1500:])
    assert ((p >= 0.5) == (y[1500:] == 1)).mean() >= 0.93
    assert 0 < len(ensemble.rules) < len(rules.grow_rules(x[:1500], y[:1500]))
    assert all(1 <= len(r.limits) <= rules.DEPTH for r in ensemble.rules)


def test_compiled_score_equals_the_matrix(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(*r, "x") for r in rows] + [(7, None, 1, "n"), (7, "", 1, "e"), (None, "é" * 50_000, 1, "l")], "doc_id long, text string, quality int, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    ensemble = rules.fit(docs, labels, held_out=lambda key: key % 3 == 0)
    got = rules.score(docs, ensemble).collect()
    assert len(got) == 303
    matrix = np.array([[r[n] for n in rules.STATISTICS] for r in got])
    assert np.allclose([r.score for r in got], ensemble.score_matrix(matrix))
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.doc_id is not None and r.doc_id % 3 == 0 and r.n_words]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in rules.score(docs, rules.fit(docs, none)).collect()] == [0.5, 0.5]
    one = rules.fit(docs, spark.createDataFrame([(1, 1)], none.schema))
    assert {r.score > 0.99 for r in rules.score(docs, one).collect()} == {True}
    assert rules.score(docs.where(F.lit(False)), one).count() == 0
