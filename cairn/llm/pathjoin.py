"""Near-duplicate texts by a chosen-path Jaccard join on five-word shingles.

Texts that are equal are one class; only classes are joined. A class has a
sketch of ``COORDINATES`` min-hashes, so two classes share a coordinate with
their Jaccard similarity as probability. One run of the join splits the classes
at sampled coordinates: those that share the value go on together, along
``BRANCHES`` coordinates at every node. A bucket of at most ``LIMIT`` members
is done; a larger one is split again at coordinates chosen by a hash of its
path, until it is small or stops shrinking. Runs are repeated until the target
recall (:func:`runs_for`). Buckets with the same members count once.

A large bucket that stops shrinking is mostly one text with small changes. Its
centre is the majority set of a few members. Jaccard distance is a metric, so
members whose similarity to the centre is at least (1 + threshold) / 2 are all
linked to each other: a core. Its links are counted, not compared, and cost one
comparison a member.

All other pairs of a bucket are compared by brute force, in large ones block by
block, so no task holds more than two blocks. A pair belongs to the first bucket that both members are in:
there its sketches are compared, and where they allow the threshold its whole
shingle sets are, so links are exact and counted once. A block pair returns one
row a member, never its pairs: the number of its links and the smallest member
of its local component. Components of all these are found by label passing with
pointer jumping over written tables.

Words are runs without space and \\x09-\\x0D; a text of one to four words is one
shingle. Defined results: null texts and texts without words are never linked
and are classes of their own, each row for itself. Otherwise ``class_id`` is the
smallest doc_id of all texts linked directly or through others, ``n_links`` the
number of different texts linked directly, ``n_copies`` the rows with an equal
text. Rows that repeat an id give a row each. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, arrow_map, ascii_words, column, forget, prepare, window_hashes, written

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
COORDINATES = 64
BRANCHES = 2
#: Members of a bucket, or of a block of a large bucket, and their shingles.
LIMIT, LIMIT_SHINGLES = 1000, 2_000_000
#: A bucket with more than this share of its parent's members isn't split again.
SHRINKS = 0.7
MAX_DEPTH = 6
#: Earlier buckets that are held against pairs at a time.
PATHS = 256
#: Members of a large bucket whose majority is its centre.
PICKS = 15

_FACTORS = np.random.default_rng(20240607).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs_for(recall: float, threshold: float) -> int:
    """Runs after which a pair at the threshold is found with that
    probability: a run finds it if, from some node on, no branch loses it."""
    found = 1.0
    for _ in range(50):
        found = 1 - (1 - threshold * found) ** BRANCHES
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def agreement_for(threshold: float) -> int:
    """Coordinates that a pair at the threshold shares but once in a million."""
    spread = math.sqrt(COORDINATES * threshold * (1 - threshold))
    return max(0, math.floor(COORDINATES * threshold - 5 * spread))


# ------------------------------------------------------------ sets
def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    words = ascii_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return np.unique(window_hashes(hashes, min(WORDS, len(words))))


def sketches(sets: list[np.ndarray]) -> list[bytes | None]:
    """Min-hashes of each set, 32 bits a coordinate."""
    full = [s for s in sets if len(s)]
    if not full:
        return [None] * len(sets)
    flat = np.concatenate(full)
    begins = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
    out = np.empty((len(full), COORDINATES), np.uint32)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = np.minimum.reduceat((flat * factor) >> np.uint64(32), begins)
    rows = iter(out)
    return [next(rows).tobytes() if len(s) else None for s in sets]


def text_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text; null without words), size, sketch."""

    def run(batch):
        known = WordHashes()
        sets = [shingles(t, known) for t in column(batch, "text")]
        keys = [k if len(s) else None for k, s in zip(column(batch, "key"), sets)]
        return {"doc_id": column(batch, "doc_id"), "key": keys, "size": [len(s) for s in sets], "sketch": sketches(sets)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("key"))
    return arrow_map(rows, run, "doc_id long, key binary, size int, sketch binary")


def text_key(text: str = "text"):
    """SHA-256: texts made to collide under a weaker digest would be merged."""
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


# ------------------------------------------------------------ buckets
def coordinate(sketch, k):
    """Value ``k`` of a sketch column as hex digits."""
    return F.hex(F.substring(sketch, k * 4 + 1, F.lit(4)))


def first_paths(runs: int):
    """The roots' children: run r splits at its own coordinates."""
    return F.array(
        *[
            F.xxhash64(F.lit(r), F.lit(b), coordinate(F.col("sketch"), F.lit((r * BRANCHES + b) % COORDINATES)))
            for r in range(runs)
            for b in range(BRANCHES)
        ]
    )


def next_paths():
    """Children of a node: coordinates chosen by a hash of its path."""
    chosen = lambda b: F.pmod(F.xxhash64("path", F.lit(b), F.lit("coordinate")), F.lit(COORDINATES)).cast("int")
    return F.array(*[F.xxhash64("path", F.lit(b), coordinate(F.col("sketch"), chosen(b))) for b in range(BRANCHES)])


def bucketed(classes: DataFrame, runs: int) -> DataFrame:
    """key, path, blocks: the buckets that are to be compared, with two members
    or more, each set of members once."""
    finals, made = [], []
    entries = classes.select("key", F.col("size"), F.lit(None).cast("long").alias("parent"), F.explode(first_paths(runs)).alias("path"))
    for depth in range(1, MAX_DEPTH + 1):
        sizes = written(
            entries.groupBy("path")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.sum(F.col("size").cast("long")).alias("shingles"),
                F.max("parent").alias("parent"),
                F.bit_xor(F.xxhash64("key")).alias("mark"),
                F.bit_xor(F.xxhash64("key", F.lit(1))).alias("mark2"),
            )
            .where("n > 1"),
            "join-sizes",
        )
        made.append(sizes)
        large = (F.col("n") > LIMIT) | (F.col("shingles") > LIMIT_SHINGLES)
        split = large & (F.col("parent").isNull() | (F.col("n") <= F.col("parent") * SHRINKS))
        if depth == MAX_DEPTH:
            split = F.lit(False)
        final = sizes.where(~split)
        finals.append(entries.select("key", "path").join(final.select("path", "n", "shingles", "mark", "mark2"), "path"))
        if depth == MAX_DEPTH or sizes.where(split).isEmpty():
            break
        entries = written(
            entries.select("key", "size", "path")
            .join(sizes.where(split).select("path", F.col("n").alias("parent")), "path")
            .join(classes.select("key", "sketch"), "key")
            .select("key", "size", "parent", F.explode(next_paths()).alias("path")),
            "join-entries",
        )
        made.append(entries)
    every = finals[0]
    for more in finals[1:]:
        every = every.unionByName(more)
    every = written(every, "join-finals")
    once = every.groupBy("n", "mark", "mark2").agg(F.min("path").alias("path")).select("path").distinct()
    blocks = blocks_for(F.col("n"), F.col("shingles"))
    out = written(every.join(written(once, "join-once"), "path").select("key", "path", blocks.alias("blocks")).distinct(), "join-buckets")
    forget(classes.sparkSession, every, *made)
    return out


def blocks_for(n, shingles):
    return F.greatest(F.ceil(n / LIMIT), F.ceil(shingles / LIMIT_SHINGLES)).cast("int")


def key_block(blocks):
    return F.pmod(F.xxhash64("key"), F.greatest(blocks, F.lit(1))).cast("int")


# ------------------------------------------------------------ cores
def centres(large: DataFrame, sets: DataFrame) -> DataFrame:
    """path, blocks, shingles: those that most of a few members of the bucket
    have. Any set would do as a centre; this one is near to many members."""
    picks = F.array_distinct(F.array(*[F.min_by("key", F.xxhash64("key", F.lit(k))) for k in range(PICKS)]))
    chosen = large.groupBy("path").agg(F.max("blocks").alias("blocks"), picks.alias("picks")).select("path", "blocks", F.explode("picks").alias("key"))
    held = sets.where(F.col("size") <= LIMIT_SHINGLES // PICKS).select("key", "shingles")
    lists = chosen.join(held, "key").groupBy("path", "blocks").agg(F.collect_list("shingles").alias("sets"))

    def run(batch):
        out = []
        for row in column(batch, "sets"):
            values, counts = np.unique(np.concatenate([np.frombuffer(s, np.uint64) for s in row]), return_counts=True)
            out.append(values[2 * counts > len(row)].tobytes())
        return {"path": column(batch, "path"), "blocks": column(batch, "blocks"), "shingles": out}

    return arrow_map(lists, run, "path long, blocks int, shingles binary")


def cores(entries: DataFrame, sets_of, threshold: float) -> DataFrame | None:
    """key, core, links, root of the keys in a core: its other members and its
    smallest key. Equal centres of several buckets are one core; a key that is
    near to several goes to the one with most keys near. None without large
    buckets. ``sets_of`` gives the shingle sets of keys."""
    large = written(entries.where("blocks > 1"), "join-large")
    if large.isEmpty():
        return None
    sets = written(sets_of(large.select("key").distinct()), "join-sets")
    middle = centres(large, sets)
    middle = middle.select("path", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(None).cast("binary").alias("key"), "shingles")
    members = large.select("path", key_block(F.col("blocks")).alias("block"), "key").join(sets.select("key", "shingles"), "key")
    dealt = members.unionByName(middle).repartition("path", "block").sortWithinPartitions("path", "block", F.col("key").asc_nulls_first())
    schema = pa.schema([("key", pa.binary()), ("core", pa.binary())])

    def run(batches):
        for batch in runs_of_groups(batches, ("path", "block")):
            keys, raw = column(batch, "key"), column(batch, "shingles")
            if keys[0] is not None:
                continue
            centre = np.frombuffer(raw[0], np.uint64)
            near = []
            for key, one in zip(keys[1:], raw[1:]):
                one = np.frombuffer(one, np.uint64)
                common = len(np.intersect1d(centre, one, assume_unique=True))
                if 2 * common >= (1 + threshold) * (len(centre) + len(one) - common):
                    near.append(key)
            if near:
                core = hashlib.sha256(raw[0]).digest()
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.binary()), pa.array([core] * len(near), pa.binary())], schema=schema)

    near = written(dealt.mapInArrow(run, "key binary, core binary").distinct(), "join-near")
    counts = written(near.groupBy("core").agg(F.count(F.lit(1)).alias("n")), "join-core-counts")
    best = hot_join(near, counts, "core").groupBy("key").agg(F.max(F.struct("n", "core")).alias("best"))
    best = written(best.select("key", F.col("best.core").alias("core")), "join-best")
    sizes = best.groupBy("core").agg((F.count(F.lit(1)) - 1).alias("links"), F.min("key").alias("root")).where("links > 0")
    out = written(hot_join(best, written(sizes, "join-core-sizes"), "core").select("key", "core", "links", "root"), "join-cores")
    forget(entries.sparkSession, large, sets, near, counts, best)
    return out


def laid_out(entries: DataFrame, found: DataFrame | None, classes: DataFrame) -> DataFrame:
    """key, path, core, inside, heads, rests: a bucket's greatest core, if any,
    has its first ``heads`` blocks (``inside``), all others the ``rests`` after."""
    plain = [F.lit(False).alias("inside"), F.lit(0).alias("heads"), F.col("blocks").alias("rests")]
    if found is None:
        return entries.select("key", "path", F.lit(None).cast("binary").alias("core"), *plain)
    marked = entries.join(found.select("key", "core"), "key", "left")
    large = written(marked.where("blocks > 1").join(classes.select("key", "size"), "key"), "join-marked")
    cells = large.groupBy("path", "core").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size").cast("long")).alias("shingles"))
    top = F.max(F.when(F.col("core").isNotNull(), F.struct("n", "core", "shingles")))
    layout = cells.groupBy("path").agg(F.sum("n").alias("n"), F.sum("shingles").alias("shingles"), top.alias("top"))
    n, shingles = (F.coalesce(F.col(f"top.{c}"), F.lit(0)) for c in ("n", "shingles"))
    layout = written(
        layout.select(
            "path", F.col("top.core").alias("first"), blocks_for(n, shingles).alias("heads"), blocks_for(F.col("n") - n, F.col("shingles") - shingles).alias("rests")
        ),
        "join-layout",
    )
    inside = F.coalesce(F.col("core") == F.col("first"), F.lit(False)).alias("inside")
    placed = hot_join(large, layout, "path").select("key", "path", "core", inside, "heads", "rests")
    return placed.unionByName(marked.where("blocks = 1").select("key", "path", "core", *plain))


def paired(entries: DataFrame) -> DataFrame:
    """Each entry once for every pair of blocks that its block is in, dealt by
    that pair and in order. Blocks of one core meet none of each other."""
    block = F.when(F.col("inside"), key_block(F.col("heads"))).otherwise(F.col("heads") + key_block(F.col("rests")))
    last = F.col("heads") + F.col("rests") - 1
    other = F.when(~F.col("inside"), F.sequence(F.lit(0), last)).when(F.col("rests") > 0, F.sequence(F.col("heads"), last))
    return (
        entries.withColumn("block", block)
        .withColumn("other", F.explode(other))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "inside", "heads", "rests")
        .repartition("path", "low", "high")
        .sortWithinPartitions("path", "low", "high")
    )


def runs_of_groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...] = ("path", "low", "high")) -> Iterator[pa.RecordBatch]:
    """One batch for each value of ``names`` in ordered batches. Groups hold two
    blocks at most."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in names])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        begins = [0, *edges.tolist()]
        for a, b in zip(begins, begins[1:]):
            yield batch.slice(a, b - a)
        held = batch.slice(begins[-1])
    if held is not None and held.num_rows:
        yield held


def sides(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks (twice the same for a block with itself)."""
    block = np.array(column(batch, "block"))
    return np.flatnonzero(block == column(batch, "low")[0]), np.flatnonzero(block == column(batch, "high")[0])


def allowed(batch: pa.RecordBatch, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """left x right: pairs of no core that this bucket decides and that sizes and
    sketches allow to reach the threshold."""
    size = np.array(column(batch, "size"), dtype=np.int64)
    a, b = size[left][:, None], size[right][None]
    ok = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
    if len(left) == len(right) and left[0] == right[0]:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))
    core = column(batch, "core")
    if any(c is not None for c in core):
        # a key of no core differs from all
        numbers = {c: k for k, c in enumerate(set(core))}
        core = np.array([-1 - k if c is None else numbers[c] for k, c in enumerate(core)])
        ok &= core[left][:, None] != core[right]
    if not ok.any():
        return ok
    sketch = np.frombuffer(b"".join(column(batch, "sketch")), np.uint32).reshape(-1, COORDINATES)
    shared = np.zeros(ok.shape, np.uint8)
    for k in range(COORDINATES):
        shared += sketch[left, k][:, None] == sketch[right, k]
    ok &= shared >= agreement_for(threshold)
    if not ok.any():
        return ok
    path = column(batch, "path")[0]
    # buckets that come earlier, of those that two members or more are in, some
    # at a time: few members can be in thousands of buckets
    rows = batch.column(batch.schema.get_field_index("paths"))
    earlier = rows.flatten().to_numpy()
    owner = np.repeat(np.arange(batch.num_rows), rows.value_lengths().to_numpy())
    owner, earlier = owner[earlier < path], earlier[earlier < path]
    _, number, count = np.unique(earlier, return_inverse=True, return_counts=True)
    number = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[number]
    for first in range(0, int((count > 1).sum()), PATHS):
        here = (number >= first) & (number < first + PATHS)
        member = np.zeros((batch.num_rows, PATHS), np.float32)
        member[owner[here], number[here] - first] = 1
        ok &= (member[left] @ member[right].T) == 0
    return ok


def with_paths(entries: DataFrame) -> DataFrame:
    """``paths``: all buckets of the key (bounded by runs, branches and depth)."""
    at = F.collect_list(F.struct("path", "inside", "heads", "rests")).alias("at")
    lists = entries.groupBy("key").agg(F.first("core").alias("core"), at)
    return lists.select("key", "core", F.col("at.path").alias("paths"), F.explode("at").alias("at")).select("key", "core", "paths", "at.*")


def promising(entries: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The entries with a partner that sketches allow."""

    def run(batches):
        for batch in runs_of_groups(batches):
            left, right = sides(batch)
            if len(left) and len(right):
                ok = allowed(batch, left, right, threshold)
                rows = np.union1d(left[ok.any(axis=1)], right[ok.any(axis=0)])
                if len(rows):
                    yield batch.take(pa.array(rows)).select(["key", "path"])

    full = with_paths(entries).join(classes.select("key", "size", "sketch"), "key")
    found = paired(full).mapInArrow(run, "key binary, path long").distinct()
    return entries.join(found, ["key", "path"])


def linked(entries: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """key, links, root: links of each member in each block pair, and the
    smallest member of its component there."""
    schema = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def run(batches):
        for batch in runs_of_groups(batches):
            left, right = sides(batch)
            if not len(left) or not len(right):
                continue
            ok = allowed(batch, left, right, threshold)
            if not ok.any():
                continue
            keys = column(batch, "key")
            links, parent = np.zeros(len(keys), np.int64), list(range(len(keys)))

            def top(k):
                while parent[k] != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            raw = [np.frombuffer(s, np.uint64) for s in column(batch, "shingles")]
            used = np.union1d(left[ok.any(axis=1)], right[ok.any(axis=0)])
            vocabulary, inverse = np.unique(np.concatenate([raw[k] for k in used]), return_inverse=True)
            ids = dict(zip(used.tolist(), np.split(inverse, np.cumsum([len(raw[k]) for k in used])[:-1])))
            mark = np.zeros(len(vocabulary), bool)
            for k in np.flatnonzero(ok.any(axis=1)):
                i, others = int(left[k]), right[ok[k]]
                mark[ids[i]] = True
                lengths = np.array([len(ids[j]) for j in others.tolist()])
                flat = np.concatenate([ids[j] for j in others.tolist()])
                common = np.add.reduceat(mark[flat].astype(np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]))
                mark[ids[i]] = False
                same = others[common >= threshold * (len(ids[i]) + lengths - common) - 1e-9]
                links[i] += len(same)
                links[same] += 1
                for j in same.tolist():
                    a, b = top(i), top(j)
                    if a != b:
                        parent[max(a, b, key=keys.__getitem__)] = min(a, b, key=keys.__getitem__)
            rows = np.flatnonzero(links)
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[k] for k in rows], pa.binary()), pa.array(links[rows]), pa.array([keys[top(k)] for k in rows], pa.binary())],
                    schema=schema,
                )

    full = paired(with_paths(entries).join(sets, "key"))
    return full.mapInArrow(run, "key binary, links long, root binary")


def shingle_sets(docs: DataFrame, keys: DataFrame, total: int) -> DataFrame:
    """key, size, sketch, shingles of the keys' (key, rep, copies) texts; ``total``
    is the number of rows."""

    def run(batch):
        known = WordHashes()
        sets = [shingles(t, known) for t in column(batch, "text")]
        return {"key": column(batch, "key"), "size": [len(s) for s in sets], "sketch": sketches(sets), "shingles": [s.tobytes() for s in sets]}

    texts = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("key"))
    # one row a text: the one with the class's id. Rows meet by text and id; of a
    # hot text, whose rows may all repeat that id, by broadcast (few, see HOT)
    hot = F.col("copies") > F.lit(max(1, total * HOT))
    rows = None
    for some in (F.broadcast(keys.where(hot)), keys.where(~hot)):
        one = texts.join(some, "key").where(F.col("doc_id").eqNullSafe(F.col("rep"))).groupBy("key").agg(F.first("text").alias("text"))
        rows = one if rows is None else rows.unionByName(one)
    return arrow_map(rows, run, "key binary, size int, sketch binary, shingles binary")


# ------------------------------------------------------------ components
#: A join key that more than this share of the rows hold is met by broadcast:
#: there are less than 1 / HOT of them.
HOT = 1e-3


def hot_join(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """``rows.join(table, key)``, where ``table`` has one row a key. Keys that more
    than ``HOT`` of the rows hold are met by broadcast, the others by shuffle, so
    a key that a third of all rows hold fills no task. Both are read again, so
    they are to be written tables."""
    if hot is None:
        hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1, rows.count() * HOT)).select(key)
    hot = written(hot, "join-hot")
    few = rows.join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key)
    return few.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each connected component. ``edges``
    (a, b) need not be symmetric. Labels are passed to neighbours, then to the
    label's own label, until none changes; each step reads written tables, and a
    much-linked node or a label of many nodes is met by broadcast."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "cc-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    hubs = written(both.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1, both.count() * HOT)).select("b"), "cc-hubs")
    while True:
        heard = hot_join(both, labels.select(F.col("node").alias("b"), F.col("label").alias("theirs")), "b", hubs).groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        lower = written(labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "theirs").alias("label")), "cc-lower")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(hot_join(lower, jump, "label").select("node", F.least("label", "further").alias("label"), "old"), "cc-labels")
        changed = not new.where(F.col("label") != F.col("old")).isEmpty()
        forget(edges.sparkSession, lower, labels)
        labels = new.select("node", "label")
        if not changed:
            forget(edges.sparkSession, both, hubs)
            return labels


# ------------------------------------------------------------ the join
def classes_of(rows: DataFrame) -> DataFrame:
    """One row a text: key, rep (smallest doc_id), copies, size, sketch."""
    return rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch")
    )


def joined_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id and key of every row; key, rep, class_id,
    class_key, n_links, copies of every text with words. Written tables."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    rows = written(text_rows(docs), "join-rows")
    classes = written(classes_of(rows), "join-classes")
    buckets, total = bucketed(classes, runs_for(recall, threshold)), rows.count()

    def sets_of(keys: DataFrame) -> DataFrame:
        return shingle_sets(docs, keys.join(classes.select("key", "rep", "copies"), "key"), total)

    inner = cores(buckets, sets_of, threshold)
    entries = written(laid_out(buckets, inner, classes), "join-laid")
    entries2 = written(promising(entries, classes, threshold), "join-entries")
    found = linked(entries2, sets_of(entries2.select("key").distinct()), threshold)
    if inner is not None:
        found = found.unionByName(inner.select("key", "links", "root"))
    found = written(found, "join-links")
    labels = components(found.where(F.col("key") != F.col("root")).select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("key").agg(F.sum("links").alias("n_links"))
    full = classes.select("key", "rep", "copies").join(counts, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left")
    full = written(full.withColumn("class_key", F.coalesce("label", "key")).drop("label"), "join-full")
    # the class goes by its smallest doc_id; ids may be null, keys are not
    least = full.groupBy("class_key").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("lead"))
    least = written(least.select("class_key", F.col("lead.rep").alias("class_id"), F.col("lead.key").alias("lead_key")), "join-least")
    out = written(
        full.join(least, "class_key").select("key", "rep", "class_id", "lead_key", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"), "join-out"
    )
    forget(spark, classes, buckets, entries, entries2, found, full, least)
    return rows.select("doc_id", "key"), out


def met(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` (with a ``key``) with their class's columns. Neither the copies of
    one text nor the rows without words meet in one task, whatever the session
    does about skew."""
    worded = rows.where(F.col("key").isNotNull())
    hot = classes.where(F.col("copies") > rows.count() * HOT).select("key")
    return hot_join(worded, classes, "key", hot).unionByName(rows.where(F.col("key").isNull()), allowMissingColumns=True)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links, n_copies: one row per row of ``docs``."""
    return met(*joined_classes(docs, threshold, recall)).select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row with
    its smallest doc_id stays (of rows that repeat it, the first by their other
    columns, maps by their JSON), and every row without words.

    Rows meet the texts that stay by text and id, so a hot text's copies with
    ids of their own spread. Copies that repeat the id too are reduced to one a
    task before they meet."""
    rows, classes = joined_classes(docs, threshold, recall)
    key, row = fresh(docs, "key"), fresh(docs, "row")
    lead = classes.where(F.col("key") == F.col("lead_key")).select(F.col("key").alias("lead"), "rep")
    # narrow: how often the id that stays is there with its text
    times = rows.where(F.col("key").isNotNull()).groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    stay = written(times.join(lead, (F.col("key") == F.col("lead")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("lead", "rep", "times"), "join-stay")
    worded = docs.where(has_words()).withColumn(key, text_key())

    def rows_of(some: DataFrame) -> DataFrame:
        return worded.join(some, (worded[key] == stay["lead"]) & worded["doc_id"].cast("long").eqNullSafe(stay["rep"]), "left_semi")

    out = rows_of(stay.where("times = 1")).select(*docs.columns).unionByName(docs.where(~has_words()))
    if stay.where("times > 1").isEmpty():
        return out
    order = F.struct(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in docs.dtypes if c != "text"])
    bound = max(1, rows.count() * HOT)
    for some in (F.broadcast(stay.where(F.col("times") > bound)), stay.where((F.col("times") > 1) & (F.col("times") <= bound))):
        first = rows_of(some).groupBy(key).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
        out = out.unionByName(first.select(f"{row}.*"))
    return out


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def has_words(text: str = "text"):
    return F.coalesce(F.length(F.translate(F.col(text), " \t\n\x0b\x0c\r", "")) > 0, F.lit(False))
