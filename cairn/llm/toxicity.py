"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters the network twice: as an entry of a word vocabulary, and as the
sum of its hashed character (byte) 3- to 5-grams. Two recurrent passes read a
window of ``WINDOW`` words, attention weighs their states, and one unit gives
the window's logit. Every text is cut into overlapping windows, all are scored,
and the largest logit is the text's. Training runs in numpy on the driver from
a bounded sample of labelled rows (``SAMPLE_ROWS`` rows of at most
``SAMPLE_CHARS`` characters): input vectors start from the log-odds of their
words and n-grams, then all weights are learned by back-propagation through
the window that scores highest in each text, chosen anew as training goes on.
The last scaling to a probability uses rows the training does not see.

Scoring keeps the input products of words met (a bounded table a task), so a
step of the network is a lookup, a small matrix product and the gates, for
thousands of windows at once.

Defined results: null and empty texts, and texts without letters or digits,
have no window and get the score of the bias alone, at most 0.49. Without
labelled rows of both classes every score is 0. Labels that repeat an id count
once, the smallest. Every row gives one row; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, column, prepare
from .quality import platt, sample

SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
WINDOW, STRIDE = 32, 16
VOCABULARY, MIN_TEXTS, FEW_TEXTS = 8192, 3, 20
GRAMS, GRAM_BUCKETS = (3, 4, 5), 1 << 18
WIDE, HIDDEN, LOOK = 4, 8, 8  # input parts, states a direction, attention units
EPOCHS, BATCH, RATE = 8, 512, 0.02
THRESHOLD = 0.5
#: Words whose input products a task keeps, and words it handles at once.
KNOWN_WORDS, AT_ONCE = 300_000, 200_000

# Lower-cased texts are cut into words at every ASCII byte but letters and digits.
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None, step: int = 1 << 20):
    """Lists of words; a very long text gives several."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + step) if at + step < len(raw) else len(raw)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def gram_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' n-grams, and the word each belongs to. A word is
    read with a mark at either end."""
    text = b"".join(b"\x02" + w + b"\x03" for w in words)
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    ends = np.cumsum(lengths)[word]
    buckets, owners = [], []
    for n in GRAMS:
        if len(b) < n:
            continue
        h = np.zeros(len(b) - n + 1, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + b[k : len(b) - n + 1 + k]
        inside = np.arange(len(h)) + n <= ends[: len(h)]
        h = (h[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (GRAM_BUCKETS - 1).bit_length())
        buckets.append(h.astype(np.int64))
        owners.append(word[: len(inside)][inside])
    if not buckets:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def window_starts(n: int) -> np.ndarray:
    """Starts of all windows of a text of ``n`` words; the last reaches its end."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else np.empty(0, np.int64)


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


# ------------------------------------------------------------ network
@dataclass
class Network:
    """Weights by name, all float32, and the word vocabulary."""

    vocabulary: dict[bytes, int]
    w: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    def inputs(self, words: list[bytes]):
        """Input vectors of words, and what back-propagation needs of them."""
        rows = np.fromiter((self.vocabulary.get(x, 0) for x in words), np.int64, len(words))
        buckets, owners = gram_buckets(words)
        sums = np.stack([np.bincount(owners, weights=self.w["grams"][buckets, k], minlength=len(words)) for k in range(WIDE)], axis=1)
        count = np.maximum(np.bincount(owners, minlength=len(words)), 1)[:, None]
        chars = np.tanh(sums / np.sqrt(count)).astype(np.float32)
        return np.concatenate([self.w["words"][rows], chars], axis=1), (rows, buckets, owners, count, chars)

    def products(self, words: list[bytes]) -> np.ndarray:
        """Gate inputs of both directions: 6 HIDDEN numbers a word."""
        return self.vectors(words) @ self.w["into"] + self.w["into_bias"]

    def vectors(self, words: list[bytes], step: int = 16_384) -> np.ndarray:
        """Input vectors only, for some words at a time: n-grams take memory."""
        parts = [self.inputs(words[k : k + step])[0] for k in range(0, len(words), step)]
        return np.concatenate(parts) if parts else np.empty((0, 2 * WIDE), np.float32)

    def states(self, gates: np.ndarray, at: np.ndarray, live: np.ndarray | None, kept: list | None = None) -> np.ndarray:
        """States (windows, WINDOW, 2 HIDDEN). ``gates``: gate inputs by row;
        ``at``: row of each word of each window; ``live``: where a word is."""
        n, steps = at.shape
        out = np.empty((steps, n, 2 * HIDDEN), np.float32)
        for way in (0, 1):
            back = self.w["back"][way]
            part = gates[:, 3 * HIDDEN * way : 3 * HIDDEN * (way + 1)]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(steps) if way == 0 else range(steps - 1, -1, -1):
                x, u = part[at[:, t]], h @ back
                zr = sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(x[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if live is not None:
                    m = live[:, t : t + 1]
                    new = np.where(m, new, h)
                if kept is not None:
                    kept.append((way, t, h, z, r, c, u[:, 2 * HIDDEN :]))
                h = new
                out[t, :, HIDDEN * way : HIDDEN * (way + 1)] = h
        return out

    def pooled(self, states: np.ndarray, live: np.ndarray | None):
        look = np.tanh(states @ self.w["look"] + self.w["look_bias"])
        e = (look @ self.w["ask"])[:, :, 0].T
        if live is not None:
            e = np.where(live, e, -1e9)
        e = np.exp(e - e.max(axis=1, keepdims=True))
        share = e / e.sum(axis=1, keepdims=True)
        context = np.einsum("nt,tnh->nh", share, states)
        return context @ self.w["out"] + self.w["out_bias"], (look, share, context)

    def logits(self, gates: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """Logit of every window; ``flat`` has the gate row of each word."""
        out = np.empty(len(starts), np.float32)
        padded = np.concatenate([flat, np.zeros(WINDOW, flat.dtype)])
        reach = np.arange(WINDOW)
        for full in (True, False):
            chosen = np.flatnonzero((lengths == WINDOW) == full)
            for k in range(0, len(chosen), at_once):
                ws = chosen[k : k + at_once]
                width = WINDOW if full else int(lengths[ws].max())
                at = padded[starts[ws][:, None] + reach[:width]]
                live = None if full else reach[:width] < lengths[ws][:, None]
                out[ws] = self.pooled(self.states(gates, at, live), live)[0][:, 0]
        return out

    def probability(self, logit):
        return sigmoid(np.clip(self.slope * logit + self.shift, -40, 40))


# ------------------------------------------------------------ training
def new_network(texts: list[list[bytes]], y: np.ndarray, rng) -> Network:
    """Inputs start from log-odds over the sample's texts, the rest at random."""
    seen: dict[bytes, list[int]] = {}
    for words, label in zip(texts, y):
        for word in set(words):
            seen.setdefault(word, [0, 0])[int(label)] += 1
    totals = [float((y == 0).sum()), float((y == 1).sum())]

    def odds(a, b):  # log-odds of a label among the texts with it, drawn to 0 where these are few
        raw = np.log((b + 0.3) / (totals[1] + 1)) - np.log((a + 0.3) / (totals[0] + 1))
        return np.clip(raw, -4, 4) * (a + b) / (a + b + FEW_TEXTS)

    often = sorted(((sum(n), w) for w, n in seen.items() if sum(n) >= MIN_TEXTS), key=lambda x: (-x[0], x[1]))
    telling = sorted(often, key=lambda x: (-abs(odds(*seen[x[1]])), x[1]))
    chosen = list(dict.fromkeys([w for _, w in often[: VOCABULARY // 2]] + [w for _, w in telling]))[: VOCABULARY - 1]
    word_rows = rng.normal(0, 0.05, (len(chosen) + 1, WIDE)).astype(np.float32)
    word_rows[0] = 0
    for k, word in enumerate(chosen, 1):
        word_rows[k, 0] = odds(*seen[word]) / 4
    gram_texts = np.zeros((2, GRAM_BUCKETS))
    for words, label in zip(texts, y):
        if words:
            gram_texts[int(label), np.unique(gram_buckets(list(set(words)))[0])] += 1
    gram_odds = np.where(gram_texts.sum(axis=0) >= MIN_TEXTS, odds(gram_texts[0], gram_texts[1]), 0)
    grams = rng.normal(0, 0.02, (GRAM_BUCKETS, WIDE)).astype(np.float32)
    grams[:, 0] = gram_odds / 4
    f = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[-2]), shape).astype(np.float32)
    w = {
        "words": word_rows, "grams": grams, "into": f(2 * WIDE, 6 * HIDDEN), "into_bias": np.zeros(6 * HIDDEN, np.float32),
        "back": f(2, HIDDEN, 3 * HIDDEN) * np.float32(0.5), "look": f(2 * HIDDEN, LOOK), "look_bias": np.zeros(LOOK, np.float32),
        "ask": f(LOOK, 1), "out": f(2 * HIDDEN, 1), "out_bias": np.zeros(1, np.float32),
    }
    return Network({word: k for k, word in enumerate(chosen, 1)}, w)


def gradients(net: Network, x: np.ndarray, at: np.ndarray, live: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Gradients of the weighted log loss of windows; also by word input."""
    w, kept = net.w, []
    gates = x @ w["into"] + w["into_bias"]
    states = net.states(gates, at, live, kept)
    logit, (look, share, context) = net.pooled(states, live)
    miss = (weight * (sigmoid(np.clip(logit[:, 0], -30, 30)) - y) / weight.sum()).astype(np.float32)[:, None]
    g = {"out": context.T @ miss, "out_bias": miss.sum(axis=0)}
    d_context = miss @ w["out"].T
    d_states = share.T[:, :, None] * d_context[None]
    d_share = np.einsum("nh,tnh->nt", d_context, states)
    d_e = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
    d_look = (d_e.T[:, :, None] * w["ask"][:, 0]) * (1 - look**2)
    g["ask"] = np.einsum("tnl,nt->l", look, d_e)[:, None]
    g["look"] = np.einsum("tnh,tnl->hl", states, d_look)
    g["look_bias"] = d_look.sum(axis=(0, 1))
    d_states = d_states + d_look @ w["look"].T
    g["back"] = np.zeros_like(w["back"])
    d_gates = np.zeros((at.shape[0], at.shape[1], 6 * HIDDEN), np.float32)
    carried = [np.zeros((len(at), HIDDEN), np.float32) for _ in range(2)]
    for way, t, h, z, r, c, un in reversed(kept):
        m = live[:, t : t + 1]
        dh = carried[way] + d_states[t][:, HIDDEN * way : HIDDEN * (way + 1)]
        on = dh * m
        d_c = on * (1 - z) * (1 - c * c)
        d_z = on * (h - c) * z * (1 - z)
        d_r = d_c * un * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
        g["back"][way] += h.T @ d_u
        carried[way] = on * z + dh * ~m + d_u @ w["back"][way].T
        d_gates[:, t, 3 * HIDDEN * way : 3 * HIDDEN * (way + 1)] = np.concatenate([d_z, d_r, d_c], axis=1)
    by_word = np.zeros((len(x), 6 * HIDDEN), np.float32)
    np.add.at(by_word, at[live], d_gates[live])
    g["into"], g["into_bias"] = x.T @ by_word, by_word.sum(axis=0)
    return g, by_word @ w["into"].T


def train(texts: list[list[bytes]], y: np.ndarray, seed: int = 11) -> Network | None:
    """Texts as word lists; ``y`` 0 or 1."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held[:] = False
    net = new_network([t for t, out in zip(texts, held) if not out], y[~held], rng)
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), np.int64)
    words, sizes = list(ids), np.array([len(t) for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    starts = [begins[k] + window_starts(n) for k, n in enumerate(sizes)]
    text = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    starts = np.concatenate(starts).astype(np.int64)
    lengths = np.minimum(WINDOW, (begins + sizes)[text] - starts)
    learn = np.flatnonzero(~held[text])
    weight = np.where(y == 1, 0.3 / y.mean(), 0.7 / (1 - y.mean()))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.w.items() if k not in ("words", "grams")}
    step = 0

    def highest(values):  # the window of each text with the largest value
        order = np.lexsort((values, text))
        return order[np.flatnonzero(np.concatenate([text[order][1:] != text[order][:-1], [True]]))]

    for epoch in range(EPOCHS):
        if epoch == 0:
            prior = net.vectors(words)[:, [0, WIDE]].sum(axis=1)[flat]
            reach = np.minimum(starts[:, None] + np.arange(WINDOW), len(flat) - 1)
            values = np.where(np.arange(WINDOW) < lengths[:, None], prior[reach], -9).max(axis=1)
        elif epoch % 2 == 0:
            values = net.logits(net.products(words), flat, starts, lengths)
        if epoch % 2 == 0:
            top = highest(values)
        extra = rng.choice(learn, min(len(learn), len(texts)), replace=False)
        chosen = np.concatenate([top[~held[text[top]]], extra[y[text[extra]] == 0]])
        chosen = rng.permutation(chosen)
        rate = RATE * (1 if epoch < EPOCHS * 2 // 3 else 0.3)
        size = int(np.clip(len(chosen) // 16, 32, BATCH))  # small samples make enough steps too
        for k in range(0, len(chosen), size):
            ws = chosen[k : k + size]
            at = np.minimum(starts[ws][:, None] + np.arange(WINDOW), len(flat) - 1)
            live = np.arange(WINDOW) < lengths[ws][:, None]
            used, local = np.unique(flat[at], return_inverse=True)
            x, (rows, buckets, owners, count, chars) = net.inputs([words[i] for i in used])
            g, by_input = gradients(net, x, local.reshape(at.shape), live, y[text[ws]], weight[text[ws]])
            step += 1
            for name, (m1, m2) in moments.items():
                m1 += 0.1 * (g[name] - m1)
                m2 += 0.01 * (g[name] ** 2 - m2)
                net.w[name] -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6)
            known = rows > 0
            np.add.at(net.w["words"], rows[known], -10 * rate * by_input[known, :WIDE])
            d_chars = by_input[:, WIDE:] * (1 - chars**2) / np.sqrt(count)
            np.add.at(net.w["grams"], buckets, (-10 * rate * d_chars[owners]).astype(np.float32))
    values = net.logits(net.products(words), flat, starts, lengths)
    top = highest(values)
    seen = top[held[text[top]]] if held.any() else top
    net.slope, net.shift = platt(values[seen].astype(float), y[text[seen]].astype(float))
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out=lambda key: F.lit(False), rows: int = SAMPLE_ROWS) -> Network | None:
    prepare(docs.sparkSession)
    # bounded: at most ``rows`` texts of at most SAMPLE_CHARS characters
    got = sample(docs, labels, label, held_out, rows, SAMPLE_CHARS).collect()
    got.sort(key=lambda r: r["doc_id"])
    texts = [[w for part in words_of(r["text"]) for w in part] for r in got]
    return train(texts, np.array([r["y"] for r in got], dtype=float))


# ------------------------------------------------------------ scoring
class _Rows(dict):
    """Word -> row of the gate inputs; new words queue until computed."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word):
        row = self[word] = len(self)
        self.new.append(word)
        return row


class Scorer:
    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self):
        self.rows, self.gates = _Rows(), np.empty((0, 6 * HIDDEN), np.float32)

    def largest(self, ids: list[np.ndarray]) -> list[float | None]:
        """Largest window logit of each text (None without words)."""
        if self.rows.new:
            self.gates = np.concatenate([self.gates, self.net.products(self.rows.new)])
            self.rows.new = []
        sizes = np.array([len(i) for i in ids])
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        starts = [begins[k] + window_starts(n) for k, n in enumerate(sizes)]
        counts = np.array([len(s) for s in starts])
        if not counts.sum():
            return [None] * len(ids)
        flat, starts = np.concatenate(ids), np.concatenate(starts)
        lengths = np.minimum(WINDOW, np.repeat(begins + sizes, counts) - starts)
        values = self.net.logits(self.gates, flat, starts, lengths)
        out, at = [], 0
        for n in counts.tolist():
            out.append(float(values[at : at + n].max()) if n else None)
            at += n
        return out

    def logits(self, texts: list[str | None]) -> list[float | None]:
        out: list[float | None] = []
        held: list[np.ndarray] = []
        size = 0
        for text in texts:
            parts = [np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)) for words in words_of(text)]
            held.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
            size += len(held[-1])
            if size >= AT_ONCE:
                out += self.largest(held)
                held, size = [], 0
                if len(self.rows) > KNOWN_WORDS:
                    self.forget()
        return out + (self.largest(held) if held else [])

    def scores(self, texts: list[str | None]) -> list[float]:
        empty = min(float(self.net.probability(self.net.w["out_bias"][0])), 0.49)
        return [empty if v is None else float(self.net.probability(v)) for v in self.logits(texts)]


_SCORERS: list[Scorer] = []


def batch_scores(batch: pa.RecordBatch, shared) -> list[float]:
    if shared.value is None:
        return [0.0] * batch.num_rows
    if not _SCORERS or _SCORERS[0].net is not shared.value:
        _SCORERS[:] = [Scorer(shared.value)]  # one a worker, so words met stay known
    return _SCORERS[0].scores(column(batch, "text"))


def score(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size, about 5 MB

    def run(batch):
        scores = batch_scores(batch, shared)
        return {"doc_id": column(batch, "doc_id"), "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` below the threshold, all their columns unchanged."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([s < threshold for s in batch_scores(batch, shared)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
