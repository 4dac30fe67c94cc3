"""The registered queries: SQL twins, contracts, and the pipeline stage by stage."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cairn.llm import bpe, packing, quality, queries, toxicity
from cairn.llm.common import WordHashes, ascii_words, table
from compare import compare
from conftest import SF_SMALL
from test_pathjoin import brute

QUERIES, ORACLE = queries.registry(), queries.oracle_sql()
COLUMNS = {
    "op3_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
    "op10_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_ngram_jaccard": ["doc_id", "class_id", "n_links", "n_copies"],
    "op12_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck_small, name):
    problems, rows = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert not problems and rows > 0, problems


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_a_row_a_document(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name]
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, SF_SMALL, "documents").select("doc_id").collect())
    if "held_out" in df.columns:
        folds, rest = (4, 2) if name.startswith("op3") else (5, 0)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == rest) for r in rows)
        assert all(r.predicted == int(r.score >= (0.7 if folds == 4 else 0.5)) for r in rows)


def test_pipeline_equals_brute_force(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model, kept = quality.fit(docs, labels), []
    for i, text in rows:
        words = ascii_words(text)
        hashes = quality.word_hashes(words, WordHashes())
        stats = quality.statistics(text, words, hashes)
        if not quality.rejected(stats[0], stats[4]) and (model is None or model.probability(quality.characters(text), hashes) >= 0.5):
            kept.append((i, text))
    first = docs.where(F.col("doc_id").isin([i for i, _ in kept]))
    net = toxicity.fit(first, labels)
    scores = toxicity.Scorer(net).scores([t for _, t in kept]) if net else [0.0] * len(kept)
    clean = [r for r, s in zip(kept, scores) if s < 0.5]
    found, _ = brute(clean)
    stay = {lead for (_, lead, _, _) in found}
    left = [(i, t) for i, t in clean if i in stay]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    tokens = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in left}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF_SMALL).collect():
        got[r.doc_id].append((r.start, r.length))
    assert {i: sorted(p) for i, p in got.items()} == {i: packing.cuts(n) for i, n in tokens.items()}
    assert 0 < len(left) < len(rows)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        table(spark, SF_SMALL, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("ids,fails", [("doc_id + 10000000", True), ("doc_id", False)])
def test_pipeline_with_labels_of_other_documents(spark, tmp_path, ids, fails):
    docs = table(spark, SF_SMALL, "documents")
    docs.withColumn("place_", F.lit(1)).withColumn("y", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    labels = table(spark, SF_SMALL, "labels").withColumn("doc_id", F.expr(ids))
    (labels if fails else labels.withColumn("toxic", F.lit(0))).write.parquet(f"{tmp_path}/labels.parquet")
    if fails:
        with pytest.raises(ValueError, match="no quality label is of a document at hand"):
            corpus_pipeline.run(spark, str(tmp_path))
    else:  # one class only: nothing to learn, nothing dropped
        stage = corpus_pipeline.toxicity_filter(spark, table(spark, str(tmp_path), "documents"), str(tmp_path))
        assert stage.columns == [*docs.columns, "place_", "y"] and stage.count() == docs.count()
        assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0  # clashing columns go through
