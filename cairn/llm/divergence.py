"""How far the sources of a language differ in their words, exactly.

Identical texts of a language are counted once for each source and collapse to
one row, the text with its multiplicities; only that text is cut into terms. A
term's occurrences and document frequency are weighted by the multiplicities
and added up in the tasks before anything is shuffled. A language keeps the
terms in at least ``min_docs`` of its documents.

Every group (lang, source), and each language as a whole, gives each kept term
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two groups differ in it by
f = floor((p - q)^2 / (p + q)). Most counts are 0, and there a group's p is one
number, its floor. So a pair of sources is evaluated sparsely:

* terms that both hold: one row each, as the difference to what the two sums
  below say of it;
* each term that one holds against the other's floor: from the histogram of
  the group's counts, one row per different count;
* the terms that neither holds: their number times f of the floors.

Defined results: null text, lang and source are ''. A text without terms, or an
empty one, still makes its (lang, source) occur. Repeated rows count each. A
language of one source has no pairs; a language without kept terms has pairs of
value 0 and no terms. Ties go to the smaller item in UTF-8 order. Other columns
of the input don't matter. An empty table gives no rows.

All sums are exact: counts are longs, the products with 10^9 decimals, p at most
10^9 + 1, so (p - q)^2 is a long as well.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Bytes that end a term become spaces, A-Z become a-z; all others stay, so a
#: character beyond ASCII is always part of a term.
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
#: Sums of a task are handed on when they hold so many terms.
HELD_TERMS = 500_000
#: Shares into which the rows of a group are dealt to meet its totals.
SALTS = 32
SCALE = 1_000_000_000


def terms(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, A-Z lower-cased."""
    return (text or b"").translate(_TERM_BYTES).split()


def filled(docs: DataFrame) -> DataFrame:
    """lang, source, text, and ``same``, a digest of the text."""
    held = {c: F.coalesce(F.col(c), F.lit("")) for c in ("lang", "source", "text")}
    return docs.select(*[v.alias(c) for c, v in held.items()]).withColumn("same", F.sha2(F.col("text"), 256))


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, groups): each text of a language once, with ``held``, its
    (source, n) multiplicities; and the (lang, source) that occur.

    Multiplicities are counted on digests alone, and copies in one task become
    one row before the shuffle, so a text that a third of all rows hold is one
    row a task. ``held`` has an entry a source at most."""
    rows = filled(docs)
    counted = written(rows.groupBy("lang", "same", "source").agg(F.count(F.lit(1)).alias("n")), "divergence-copies")
    held = counted.groupBy("lang", "same").agg(F.collect_list(F.struct("source", "n")).alias("held"))
    texts = rows.groupBy("lang", "same").agg(F.first("text").alias("text"))
    return texts.join(held, ["lang", "same"]).select("lang", "text", "held"), counted.select("lang", "source").distinct()


def term_sums(texts: DataFrame) -> DataFrame:
    """lang, term, df, held: partial sums, a row or a few a task; ``held`` has
    the term's occurrences (source, n) by source."""
    most = HELD_TERMS
    entry = pa.struct([("source", pa.string()), ("n", pa.int64())])
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("held", pa.list_(entry))])

    def batch_of(lang: str, dfs: Counter, sums: dict[str, Counter]) -> pa.RecordBatch:
        at = {t: k for k, t in enumerate(dfs)}
        place = np.concatenate([np.fromiter(map(at.__getitem__, c), np.int64, len(c)) for c in sums.values()])
        count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in sums.values()])
        of = np.repeat(np.arange(len(sums)), [len(c) for c in sums.values()])
        order = np.argsort(place, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(at)))])
        held = pa.StructArray.from_arrays([pa.array(list(sums), pa.string()).take(pa.array(of[order])), pa.array(count[order])], fields=list(entry))
        cols = [
            pa.repeat(pa.scalar(lang, pa.string()), len(at)),
            pa.array([t.decode("utf-8", "replace") for t in dfs], pa.string()),
            pa.array(np.fromiter(dfs.values(), np.int64, len(at))),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held),
        ]
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def run(batches):
        sums, dfs, size = defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter), 0
        for batch in batches:
            langs, held = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lang, text, groups in zip(langs, batch.column(1).cast(pa.binary()).to_pylist(), held):
                words = terms(text)
                if not words:
                    continue
                copies = sum(g["n"] for g in groups)
                add(dfs[lang], set(words), copies)
                for g in groups:
                    into = sums[lang][g["source"]]
                    size -= len(into)
                    add(into, words, g["n"])
                    size += len(into)
                if size >= most:
                    for x in dfs:
                        yield batch_of(x, dfs[x], sums[x])
                    sums.clear()
                    dfs.clear()
                    size = 0
        for x in dfs:
            yield batch_of(x, dfs[x], sums[x])

    return texts.mapInArrow(run, "lang string, term string, df long, held array<struct<source:string,n:long>>")


def add(into: Counter, words, copies: int) -> None:
    if copies == 1:
        into.update(words)
    else:
        into.update({t: n * copies for t, n in Counter(words).items()})


def kept_terms(sums: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, n of the terms in ``min_docs`` documents of the lang;
    ``total``, the term's count in the lang.

    One shuffle by (lang, term); a term's document frequency goes along as the
    row without a source, and a window over its rows (one a source) hands it on."""
    dealt = sums.repartition("lang", "term")
    flat = dealt.select("lang", "term", F.inline(F.array_append("held", F.struct(F.lit(None).cast("string").alias("source"), F.col("df").alias("n")))))
    whole = flat.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    term = Window.partitionBy("lang", "term")
    docs = F.max(F.when(F.col("source").isNull(), F.col("n"))).over(term)
    total = F.sum(F.when(F.col("source").isNotNull(), F.col("n"))).over(term)
    held = whole.select("lang", "source", "term", "n", total.alias("total"), docs.alias("df"))
    return held.where((F.col("df") >= min_docs) & F.col("source").isNotNull()).drop("df")


def chance(count: str, total: str, size: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 size)); null if nothing is kept."""
    over = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))"
    return F.expr(f"CASE WHEN {size} > 0 THEN 1 + ({over}) DIV CAST({total} + 2 * {size} AS DECIMAL(20,0)) END")


def apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of longs."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def salted(df: DataFrame, *by: str) -> DataFrame:
    return df.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))


def to_all_salts(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def group_totals(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total, held (kept terms that occur there), size (V) and
    lang_total of every group, and ``floor``, its p of a term it lacks."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    langs = kept.select("lang", "term", "total").distinct()
    langs = langs.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("total").alias("lang_total"))
    counts = ["total", "held", "size", "lang_total"]
    whole = groups.join(own, ["lang", "source"], "left").join(langs, ["lang"], "left").fillna(0, counts)
    return whole.withColumn("floor", chance("0L", "total", "size"))


def pair_values(chances: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, a, b, value of every two sources a < b of a language."""
    a = chances.selectExpr("lang", "term", "source AS a", "p", "floor AS p0")
    b = chances.selectExpr("lang", "term", "source AS b", "p AS q", "floor AS q0")
    both = (
        a.join(b, ["lang", "term"])
        .where("a < b")
        .select("lang", "a", "b", (apart("p", "q") - apart("p", "q0") - apart("p0", "q") + apart("p0", "q0")).alias("v"))
    )
    shapes = chances.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("many"))
    others = to_all_salts(totals.selectExpr("lang", "source AS other", "floor", "held AS other_held"))
    one = (
        salted(shapes, "source", "p")
        .join(others, ["lang", "salt"])
        .where("source <> other")
        .select("lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"), (F.col("many") * apart("p", "floor")).alias("v"))
    )
    neither = (
        salted(totals.selectExpr("lang", "source", "floor AS p0", "held", "size"), "source")
        .join(others, ["lang", "salt"])
        .where("source < other")
        .select(
            "lang", F.col("source").alias("a"), F.col("other").alias("b"),
            F.when(F.col("size") > 0, (F.col("size") - F.col("held") - F.col("other_held")) * apart("p0", "floor")).otherwise(F.lit(0)).alias("v"),
        )
    )
    return both.unionByName(one).unionByName(neither).groupBy("lang", "a", "b").agg(F.sum("v").alias("value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: each group's distance to every
    other source of its language (part ``pair``), and the ``top`` terms it has
    more of than the language (part ``term``)."""
    texts, groups = collapsed(docs)
    kept = written(kept_terms(term_sums(texts), min_docs), "divergence-kept")
    totals = written(group_totals(groups, kept), "divergence-groups")
    sizes = to_all_salts(totals.select("lang", "source", "size", "lang_total", "floor", F.col("total").alias("group_total")))
    chances = (
        salted(kept, "term")
        .join(sizes, ["lang", "source", "salt"])
        .withColumn("p", chance("n", "group_total", "size"))
        .withColumn("q", chance("total", "lang_total", "size"))
        .select("lang", "source", "term", "p", "q", "floor")
    )
    chances = written(chances, "divergence-chances")
    pairs = pair_values(chances, totals)
    sides = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a", "b"), ("b", "a"))])
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (
        pairs.select("lang", F.inline(sides), "value")
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    )
    words = (
        chances.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), apart("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
    )
    return pairs.unionByName(words)
