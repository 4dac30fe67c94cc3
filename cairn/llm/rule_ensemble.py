"""Quality score by a sparse rule ensemble.

Tasks turn each text into a row of statistics. From a bounded sample of
labelled rows (``SAMPLE_ROWS`` of at most ``SAMPLE_CHARS`` characters) small
trees are grown on the driver, each on the errors of those before it; every
path from a root is a rule, a conjunction of limits on statistics. A lasso
logistic regression weighs the rules and drops most. The rules left are
compiled into Spark column expressions, so a score is one expression over the
statistics.

Defined results: null and empty texts have all statistics 0 and get a score like
others. Without labelled rows of both classes every score is the share of
label 1 among the labels seen, or 0.5 without any. Rows that repeat an id are
scored each; labels that repeat an id count once, the smallest. Labels, lang,
source and doc_id are no inputs. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, arrow_map, ascii_words, column, prepare
from .quality import platt, repeated_words, sample, word_hashes

SAMPLE_ROWS = 5000
TREES, DEPTH, MIN_LEAF = 24, 3, 8
#: Lasso strengths tried, as shares of the largest that leaves one rule.
PENALTIES = (0.1, 0.03, 0.01, 0.003)

STATISTICS = (
    "n_words", "mean_word", "upper_share", "digit_share", "symbol_share", "pipe_share", "bang_share", "stop_share",
    "comma_share", "non_ascii_share", "line_share", "blank_share", "bracket_share", "control_share",
    "distinct_words", "distinct_pairs", "duplicate_lines", "repeated_share", "top_word_share", "longest_word", "byte_entropy",
)


def text_statistics(text: str | None, known: WordHashes) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = ascii_words(text)
    if not words:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    total = float(len(raw))
    share = lambda chars: float(sum(counts[c] for c in chars)) / total
    hashes = word_hashes(words, known)
    ordered = np.sort(hashes)
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    pairs = np.unique(hashes[:-1] * np.uint64(31) + hashes[1:]) if len(words) > 1 else hashes
    lines = [line for line in text.split("\n") if line]
    p = counts[counts > 0] / total
    n = float(len(words))
    return [
        n,
        sum(map(len, words)) / n,
        share(range(65, 91)),
        share(range(48, 58)),
        share(b"#*$%&<>@^~=+\\"),
        share(b"|"),
        share(b"!"),
        share(b".?"),
        share(b",;:"),
        float(counts[128:].sum()) / total,
        share(b"\n"),
        share(b" \t"),
        share(b"()[]{}"),
        float(counts[:9].sum() + counts[14:32].sum()) / total,
        (len(edges) - 1) / n,
        len(pairs) / max(n - 1, 1.0),
        1 - len(set(lines)) / max(len(lines), 1),
        repeated_words(hashes) / n,
        float(np.diff(edges).max()) / n,
        float(max(map(len, words))),
        float(-(p * np.log2(p)).sum()),
    ]


def with_statistics(docs: DataFrame, keep: dict[str, str]) -> DataFrame:
    """Columns ``keep`` (name -> type) and one double a statistic."""
    prepare(docs.sparkSession)

    def run(batch):
        known = WordHashes()
        rows = np.array([text_statistics(t, known) for t in column(batch, "text")]).reshape(-1, len(STATISTICS))
        return {name: column(batch, name) for name in keep} | {name: rows[:, k] for k, name in enumerate(STATISTICS)}

    schema = ", ".join([f"{n} {t}" for n, t in keep.items()] + [f"{n} double" for n in STATISTICS])
    return arrow_map(docs.select(*keep, "text"), run, schema)


# ------------------------------------------------------------ trees
@dataclass
class Rule:
    """Holds where every (statistic, above, limit) does."""

    limits: list[tuple[int, bool, float]]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, limit in self.limits:
            out &= (x[:, k] > limit) if above else (x[:, k] <= limit)
        return out

    def condition(self) -> Column:
        out = F.lit(True)
        for k, above, limit in self.limits:
            c = F.col(STATISTICS[k])
            out = out & ((c > F.lit(limit)) if above else (c <= F.lit(limit)))
        return out


@dataclass
class Ensemble:
    rules: list[Rule] = field(default_factory=list)
    bias: float = 0.0

    def score(self) -> Column:
        """The compiled score: one column expression over the statistics."""
        total = F.lit(float(self.bias))
        for rule in self.rules:
            total = total + F.when(rule.condition(), F.lit(float(rule.weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def score_matrix(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule in self.rules:
            z += rule.weight * rule.holds(x)
        return 1 / (1 + np.exp(-z))


def best_split(x: np.ndarray, pull: np.ndarray, curve: np.ndarray, features: np.ndarray):
    """(gain, statistic, limit) of the split with the largest Newton gain."""
    best = (1e-6, -1, 0.0)
    g, h = pull.sum(), curve.sum()
    for k in features:
        order = np.argsort(x[:, k], kind="stable")
        v = x[order, k]
        gl, hl = np.cumsum(pull[order])[:-1], np.cumsum(curve[order])[:-1]
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
        gain[v[1:] == v[:-1]] = -1
        gain[: MIN_LEAF - 1] = -1
        gain[len(gain) - MIN_LEAF + 1 :] = -1
        at = int(gain.argmax()) if len(gain) else -1
        if at >= 0 and gain[at] > best[0]:
            best = (float(gain[at]), int(k), float((v[at] + v[at + 1]) / 2))
    return best


def grow(x, pull, curve, rng, depth=DEPTH) -> list[tuple[list, float]]:
    """Paths of one tree: (limits, value) of every node below the root."""
    paths = []

    def node(rows, limits, left):
        if limits:
            paths.append((limits, float(pull[rows].sum() / (curve[rows].sum() + 1)), left == 0))
        if left == 0 or len(rows) < 2 * MIN_LEAF:
            return paths and limits and paths.__setitem__(-1, (*paths[-1][:2], True))
        features = rng.permutation(x.shape[1])[: max(4, x.shape[1] // 2)]
        gain, k, limit = best_split(x[rows], pull[rows], curve[rows], features)
        if k < 0:
            return paths and limits and paths.__setitem__(-1, (*paths[-1][:2], True))
        above = x[rows, k] > limit
        node(rows[~above], [*limits, (k, False, limit)], left - 1)
        node(rows[above], [*limits, (k, True, limit)], left - 1)

    node(np.arange(len(x)), [], depth)
    return paths


def grow_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> list[Rule]:
    rng, z, rules = np.random.default_rng(seed), np.zeros(len(y)), {}
    z += np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        rows = rng.permutation(len(y))[: max(2 * MIN_LEAF, len(y) * 3 // 5)]
        for limits, value, leaf in grow(x[rows], (y - p)[rows], (p * (1 - p))[rows], rng):
            rule = Rule(limits)
            rules.setdefault(tuple(limits), rule)
            if leaf:
                z += 0.3 * np.clip(value, -4, 4) * rule.holds(x)
    return list(rules.values())


# ------------------------------------------------------------ lasso
def lasso(f: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, start=None, steps: int = 200):
    """Accelerated proximal gradient for the l1-penalised logistic loss; the
    bias (last entry) goes free."""
    n, m = f.shape
    weight = weight.astype(f.dtype)
    v = np.ones(m, f.dtype)
    for _ in range(10):  # the largest curvature, by power steps
        v = f.T @ (weight * (f @ v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 4 / (1.1 * top / n + float(weight.max()))
    y = y.astype(f.dtype)
    w = np.zeros(m + 1, f.dtype) if start is None else start.copy()
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(f @ ahead[:m] + ahead[m], -30, 30)))
        miss = weight * (p - y) / n
        new = ahead - rate * np.concatenate([f.T @ miss, [miss.sum()]])
        new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t2 * (new - w)
        if np.abs(new - w).max() < 1e-5:
            w = new
            break
        w, t = new, t2
    return w


def fit_rules(x: np.ndarray, y: np.ndarray) -> Ensemble:
    if len(y) == 0:
        return Ensemble()
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    if len(set(y.tolist())) < 2 or len(y) < 4 * MIN_LEAF:
        return Ensemble(bias=float(np.log(share / (1 - share))))
    rules = grow_rules(x, y)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held[:] = False
    different = {r.holds(x).tobytes(): r for r in rules}  # one of the rules that hold on the same rows
    rules = list(different.values())
    f = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float32)
    spread = np.sqrt(np.maximum(f.mean(axis=0) * (1 - f.mean(axis=0)), 1e-4))
    scaled = ((f - f.mean(axis=0)) / spread).astype(np.float32)
    even = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    top = np.abs(scaled.T @ (even * (y - 0.5))).max() / len(y)
    test = held if held.any() else ~held
    best, start = None, None
    for part in PENALTIES:
        start = lasso(scaled[~held], y[~held], even[~held], part * top, start)
        z = scaled[test] @ start[:-1] + start[-1]
        loss = float((even[test] * np.logaddexp(0, np.where(y[test] == 1, -z, z))).mean())
        if best is None or loss < best[0] - 1e-4:
            best = (loss, part)
    w = lasso(scaled, y, even, best[1] * top, start)
    z = scaled @ w[:-1] + w[-1]
    slope, shift = platt(z, y)
    weights = slope * w[:-1] / spread
    chosen = [Rule(r.limits, float(v)) for r, v in zip(rules, weights) if v]
    bias = slope * w[-1] + shift - float((weights * f.mean(axis=0)).sum())
    return Ensemble(chosen, float(bias))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out=lambda key: F.lit(False), rows: int = SAMPLE_ROWS) -> Ensemble:
    chosen = sample(docs, labels, label, held_out, rows)
    got = with_statistics(chosen, {"doc_id": "long", "y": "double"}).collect()  # at most ``rows`` short rows
    got.sort(key=lambda r: r["doc_id"])
    x = np.array([[r[n] for n in STATISTICS] for r in got]).reshape(-1, len(STATISTICS))
    return fit_rules(x, np.array([r["y"] for r in got], dtype=float))


def score(docs: DataFrame, ensemble: Ensemble, threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted, and the statistics."""
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), {"doc_id": "long"})
    scored = rows.withColumn("score", ensemble.score())
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *STATISTICS)
