"""Quality rules: text statistics with fixed limits, then a calibrated logistic
regression over hashed word and character n-grams.

Features of a text are the shares of its word 1- and 2-grams and its character
1-, 2- and 3-grams (of code points), each hashed into a fixed number of buckets.
A text's score needs one weighted sum per n-gram family, so scoring an Arrow
batch is table lookups over all its characters and words at once: whole texts,
whatever their length. The regression is fitted in numpy on the driver from a bounded sample
of labelled rows (``SAMPLE_ROWS`` rows of at most ``SAMPLE_CHARS`` characters);
their features are computed by tasks. It learns from those that pass the fixed
limits, as only these need its verdict. Calibration (Platt) uses the part of the
sample that the fit does not see.

Defined results: null and empty texts have no words, so the rules reject them.
Without labelled rows of both classes there is no model, and a text that passes
the rules is kept. Labels that repeat an id count once, the smallest label of
the id (null labels are ignored). Every row gives one row; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, ascii_words, arrow_map, column, mix, prepare, window_hashes

SAMPLE_ROWS = 3000
SAMPLE_CHARS = 200_000
#: Buckets of each n-gram family (a power of two).
BUCKETS = 2048
FAMILIES = ("word 1", "word 2", "character 1", "character 2", "character 3")
#: Texts are kept from this calibrated probability of label 1 on.
KEEP_FROM = 0.5
#: Odd factors of the character hashes.
_FACTORS = tuple(np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

# Fixed values of the rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


# ------------------------------------------------------------ statistics
def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    windows = window_hashes(hashes, WINDOW)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(windows) + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    marks = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def statistics(text: str | None, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not words:
        return 0, 0, sum(text.count(c) for c in SYMBOLS) if text else 0, 0, 0
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    chars = len(text) - sum(text.count(c) for c in SPACES)
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(hashes)


def rejected(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


# ------------------------------------------------------------ features
def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def characters(text: str | None) -> np.ndarray:
    """The text's code points."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(chars: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """Bucket of every n-gram, one array per family. A code point has 21 bits, so
    up to three of them fit in a long, which a product and a shift hash."""
    mask, shift = np.uint64(BUCKETS - 1), np.uint64(64 - (BUCKETS - 1).bit_length())
    one = chars.astype(np.uint64)
    two = one[:-1] << np.uint64(21) | one[1:]
    three = two[:-1] << np.uint64(21) | one[2:]
    spread = [((n * factor) >> shift).astype(np.intp) for n, factor in zip((one, two, three), _FACTORS)]
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    return [(hashes & mask).astype(np.intp), (pairs & mask).astype(np.intp), *spread]


@dataclass
class Model:
    weights: np.ndarray  # families x BUCKETS
    bias: float
    slope: float
    shift: float

    def probability(self, chars: np.ndarray, hashes: np.ndarray) -> float:
        z = self.bias
        for w, g in zip(self.weights, grams(chars, hashes)):
            if len(g):
                z += float(w[g].mean())
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40)))


def labels_fit(docs: DataFrame, labels: DataFrame, label: str) -> None:
    """Raise where there are labels, and documents to learn from, but no label is of
    one of these documents: a stage would then keep everything without a word."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    known = texts.join(usable.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    if not usable.isEmpty() and not texts.isEmpty() and known.isEmpty():
        raise ValueError(f"no {label} label is of a document at hand")


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """doc_id, text, y: at most ``rows`` labelled rows of at most ``chars``
    characters, chosen by a hash of the id among those that are not held out and
    have such a text. Labels of other documents don't count against ``rows``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= chars)
    )
    ids = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).cast("double").alias("y"))
        .where(~held_out(F.col("doc_id")))
        .join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # the ids are at most ``rows`` rows, so this side may be broadcast
    # rows that repeat an id give its smallest text, so the sample never depends on order
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out=lambda key: F.lit(False), rows: int = SAMPLE_ROWS) -> Model | None:
    prepare(docs.sparkSession)
    width = len(FAMILIES) * BUCKETS

    def features(batch):
        known, out = WordHashes(), {"doc_id": [], "y": [], "f": []}
        for doc_id, y, text in zip(column(batch, "doc_id"), column(batch, "y"), column(batch, "text")):
            words = ascii_words(text)
            hashes = word_hashes(words, known)
            stats = statistics(text, words, hashes)
            if rejected(stats[0], stats[4]):
                continue
            x = np.zeros(width, np.float32)
            for f, g in enumerate(grams(characters(text), hashes)):
                if len(g):
                    x[f * BUCKETS : (f + 1) * BUCKETS] = np.bincount(g, minlength=BUCKETS) / np.float32(len(g))
            at = np.flatnonzero(x).astype(np.uint16)
            for name, value in (("doc_id", doc_id), ("y", y), ("f", {"at": at.tobytes(), "x": x[at].tobytes()})):
                out[name].append(value)
        return out

    # bounded: at most ``rows`` sparse vectors of ``width`` entries
    got = arrow_map(sample(docs, labels, label, held_out, rows), features, "doc_id long, y double, f struct<at:binary,x:binary>").collect()
    if len({r["y"] for r in got}) < 2:
        return None
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    x = np.zeros((len(got), width), np.float32)  # at most 120 MB
    for k, r in enumerate(got):
        x[k, np.frombuffer(r["f"]["at"], np.uint16)] = np.frombuffer(r["f"]["x"], np.float32)
    y = np.array([r["y"] for r in got], np.float32)
    return fit_matrix(x, y)


def fit_matrix(x: np.ndarray, y: np.ndarray, steps: int = 300, penalty: float = 1e-3) -> Model:
    """Logistic regression by Nesterov steps on scaled features, then Platt
    scaling on the last quarter of the rows (which come in no order), left out
    of the fit. Scales ``x`` in place."""
    n = len(y) - len(y) // 4 if len(y) >= 40 else len(y)
    xs, ys = x[:n], y[:n]
    scale = (1 / np.maximum(np.sqrt(np.einsum("ij,ij->j", xs, xs) / n), 1e-3)).astype(np.float32)
    x *= scale
    class_weight = np.where(ys == 1, 0.5 / max(ys.mean(), 1e-6), 0.5 / max(1 - ys.mean(), 1e-6)).astype(np.float32)
    v = np.ones(xs.shape[1], np.float32)
    for _ in range(12):  # the largest curvature, by power steps
        v = xs.T @ (xs @ v)
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1 / (0.25 * float(class_weight.max()) * (top / len(ys) + 1) + penalty)
    w, seen, bias, seen_bias = np.zeros_like(v), np.zeros_like(v), 0.0, 0.0
    for step in range(steps):
        pull = step / (step + 3)
        ahead, ahead_bias = (w + pull * (w - seen)).astype(np.float32), bias + pull * (bias - seen_bias)
        p = 1 / (1 + np.exp(-np.clip(xs @ ahead + ahead_bias, -30, 30)))
        miss = (class_weight * (p - ys) / len(ys)).astype(np.float32)
        seen, seen_bias = w, bias
        w = ahead - rate * (xs.T @ miss + penalty * ahead)
        bias = ahead_bias - rate * float(miss.sum())
    z = x @ w.astype(np.float32) + bias
    weights = w * scale
    slope, shift = platt(z[n:], y[n:]) if len(set(y[n:].tolist())) == 2 else platt(z, y)
    return Model(weights.reshape(len(FAMILIES), BUCKETS).astype(np.float64), bias, slope, shift)


def platt(z: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope (positive) and shift with sigmoid(slope z + shift) ~ y, by Newton
    steps with smoothed targets."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2)).astype(np.float64)
    z = z.astype(np.float64)
    unit = max(float(np.abs(z).mean()), 1e-9)
    f = np.stack([z / unit, np.ones_like(z)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(f @ theta, -30, 30)))
        gradient = f.T @ (p - target) + 1e-3 * theta
        hessian = (f * (p * (1 - p))[:, None]).T @ f + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        theta -= step * min(1.0, 5 / max(float(np.abs(step).max()), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-6) / unit, float(theta[1])


# ------------------------------------------------------------ verdicts
COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, quality_score double"


def judge_batch(batch: pa.RecordBatch, model: Model | None, keep_from: float) -> dict:
    known = WordHashes()
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    out = {n: [] for n in names}
    for text in column(batch, "text"):
        words = ascii_words(text)
        hashes = word_hashes(words, known)
        stats = statistics(text, words, hashes)
        failed = rejected(stats[0], stats[4])
        score = None
        if model is not None:
            score = float(model.probability(characters(text), hashes))
        kept = not failed and (score is None or score >= keep_from)
        for name, value in zip(names, (*stats, failed, kept, score)):
            out[name].append(value)
    return out


def judge(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, the statistics, ``base_failed``, ``kept`` and ``quality_score``
    (the calibrated probability of label 1; null without a model)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(rows, lambda b: {"doc_id": column(b, "doc_id")} | judge_batch(b, shared.value, keep_from), f"doc_id long, {COLUMNS}")


def keep_good(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(judge_batch(batch, shared.value, keep_from)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
