"""Source divergence against exact Python integers."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cairn.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, min_docs, top):
    langs = defaultdict(lambda: (Counter(), defaultdict(Counter)))
    for text, lang, source in rows:
        found = [t.translate(LOWER) for t in TERM.findall(text or "")]
        docs, counts = langs[lang or ""]
        docs.update(set(found))
        counts[source or ""].update(found)
    out = []
    for lang, (docs, counts) in langs.items():
        kept = [t for t, n in docs.items() if n >= min_docs]
        v = len(kept)

        def chances(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * v) for t in kept}

        whole = chances(sum(counts.values(), Counter()))
        each = {s: chances(c) for s, c in counts.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, p in each.items():
            far = [(-sum(f(p[t], q[t]) for t in kept), o.encode()) for o, q in each.items() if o != s]
            out += [(lang, s, "pair", o.decode(), -x, r) for r, (x, o) in enumerate(sorted(far), 1)]
            more = sorted((-f(p[t], whole[t]), t.encode()) for t in kept if counts[s][t] and p[t] > whole[t])
            out += [(lang, s, "term", t.decode(), -x, r) for r, (x, t) in enumerate(more[:top], 1)]
    return sorted(out)


def got(spark, rows, **how):
    schema = "text string, lang string, source string, salt int, rank string, term double, same int"
    docs = spark.createDataFrame([(*r, 1, "x", 0.5, 3) for r in rows], schema).repartition(3)
    df = divergence.audit(docs, **how)
    assert df.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    return sorted(tuple(r) for r in df.collect())


def some_rows():
    rng = random.Random(3)
    words = ["Haus", "über", "straße", "ÄRGER", "x", "日本", "naïve", "the", "The", "end's", "a1b", "z\x00y", "q r"]
    rows = []
    for k in range(150):
        text = rng.choice([" ", "\n", "-"]).join(rng.choices(words, k=rng.randint(0, 12)))
        rows.append((text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", "S1", None])))
    rows += [("copied text of the crowd", "en", rng.choice(["s1", "s2"])) for _ in range(120)]
    rows += [("Copied text of the crowd", "de", "s1")] * 3 + [(None, "en", "only nulls"), ("", "xx", "a"), ("12 34", "xx", "b"), ("alone", "yy", "one")]
    return rows + [("word " * 20000, "en", "long")]


def test_equals_brute_force(spark):
    rows = some_rows()
    assert got(spark, rows, min_docs=10, top=3) == brute(rows, 10, 3)
    assert got(spark, rows[:40], min_docs=2, top=10) == brute(rows[:40], 2, 10)


def test_small_tasks_sums_and_no_kept_terms(spark, monkeypatch):
    rows = some_rows()[:60]
    assert got(spark, rows, min_docs=1000, top=3) == brute(rows, 1000, 3)
    task = divergence.term_sums
    monkeypatch.setattr(divergence, "HELD_TERMS", 3)  # read when the task is made
    texts, _ = divergence.collapsed(spark.createDataFrame(rows, "text string, lang string, source string"))
    many = task(texts).selectExpr("lang", "term", "inline(held)")
    sums = {(r.lang, r.source, r.term): r.n for r in many.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).collect()}
    want = Counter((lang or "", s or "", t.translate(LOWER)) for text, lang, s in rows for t in TERM.findall(text or ""))
    assert sums == dict(want)


def test_empty_table_and_counts_beyond_long_products(spark):
    empty = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.audit(empty).count() == 0
    row = spark.sql("SELECT 9000000000000L AS n, 90000000000000L AS total, 7L AS size")
    p = row.select(divergence.chance("n", "total", "size")).first()[0]
    assert p == 1 + 10**9 * (9 * 10**12 + 2) // (9 * 10**13 + 14)


def test_a_crowd_of_copies_is_tokenised_once(spark):
    rows = [("one text of many", "en", f"s{k % 3}") for k in range(3000)]
    texts, groups = divergence.collapsed(spark.createDataFrame(rows, "text string, lang string, source string").repartition(8))
    (one,) = texts.collect()
    assert sorted((g.source, g.n) for g in one.held) == [("s0", 1000), ("s1", 1000), ("s2", 1000)]
    assert groups.count() == 3
