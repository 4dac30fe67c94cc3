"""BPE against the tokenizers library, and exact round trips."""

import hashlib
import random
from array import array

import pytest
from tokenizers import Tokenizer

from cairn.llm import bpe

LIBRARY = Tokenizer.from_file(bpe.default_vocabulary())
SPEC = open(bpe.default_vocabulary(), encoding="utf-8").read()


def odd_texts():
    rng = random.Random(3)
    letters = [*"aé ß\n\t 'sxyz12٣\x85\xa0　\x1c​中文!?..\U0001f600", "<|endoftext|>", "  ", "\n\n", "'ll", "'re"]
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    out += ["a" * 6000, "ab" * 3000, " " * 300, "\n" * 77 + "x", "word " * 5000, "x" + " " * 5]
    return out + [f"{chr(c)} {chr(c)}a1{chr(c)}" for c in range(1, 0x3000, 7)]


@pytest.mark.parametrize("by_library", [False, True])
def test_ids_and_text_equal_the_library(by_library):
    own = bpe.ForcedCutBPE(SPEC, by_library)
    for text in odd_texts():
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert array("I", got).tolist() == ids, text[:60]
        assert own.decode(got) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_texts_of_short_runs_go_to_the_library_whole(monkeypatch):
    """No piece is looked up one by one there; longer runs are cut as before."""
    texts = ["a new wörd, " * 50 + f"{k} \u4e2d\u6587\n\n '{chr(0x300 + 17 * k)}s" for k in range(200)]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    own = bpe.ForcedCutBPE(SPEC, by_library=True)
    assert [array("I", own.encode(t)).tolist() for t in texts] == want
    assert not own.word_ids and not own.token_ids
    monkeypatch.setattr(bpe, "LIBRARY_RUN", 5)
    assert [array("I", own.encode(t)).tolist() for t in texts + odd_texts()] == want + [LIBRARY.encode(t, add_special_tokens=False).ids for t in odd_texts()]
    assert own.word_ids


def test_longest_runs():
    for text, n in (("a", 1), ("ab cd", 3), ("ab " + " " * 9 + "cd", 11), (" \u2003" * 20, 80), (" \n" * 20 + "x", 41), (" é" * 9, 3), ("x" * 600 + " y", 600)):
        assert bpe.longest_run(text) == n
    for text in odd_texts():
        if text:
            assert max(len(t.encode()) for t in bpe.regex.findall(bpe.PATTERN, text)) <= bpe.longest_run(text)


def test_cuts_are_certain():
    own = bpe.ForcedCutBPE(SPEC)
    assert 0 < own.inside.count(0) < 65536  # some byte pairs occur in no token
    for token in own.bytes_of.values():
        assert all(own.inside[a * 256 + b] for a, b in zip(token, token[1:]))


def test_stored_pieces_stay_bounded():
    own = bpe.ForcedCutBPE(SPEC)
    own.word_ids.limit = own.token_ids.limit = own.pair_fits.limit = 10
    text = " ".join(f"wörd{k}, x{k}" for k in range(300))
    assert array("I", own.encode(text)).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert len(own.word_ids) <= 10


def test_query_rows(spark):
    rows = [(1, None), (1, ""), (2, "Ein Satz, dann <|endoftext|> mehr."), (None, "x" * 50_000), (2, "Ein Satz, dann <|endoftext|> mehr.")]
    docs = spark.createDataFrame([(i, t, "a", 3) for i, t in rows], "doc_id long, text string, ids string, n_tokens int")
    want = sorted(
        (i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in [(i or -1, t) for i, t in rows]
        for ids in [LIBRARY.encode(t or "", add_special_tokens=False).ids]
    )
    assert sorted((r[0] or -1, *r[1:]) for r in bpe.round_trip(docs).collect()) == want
    coded = bpe.encode(docs)
    assert coded.columns == ["doc_id", "text", "n_tokens", "ids"]
    back = bpe.decode(coded.withColumnRenamed("text", "before"))
    assert all(r.text == (r.before or "") for r in back.collect())
    assert bpe.round_trip(docs.limit(0)).count() == 0
