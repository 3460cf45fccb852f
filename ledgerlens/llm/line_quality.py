"""Operator 11: document quality by a linear-chain conditional random field over lines.

1. A line is described by shares of byte classes, repetition and length, and by the same values of
   the lines before and behind it.
2. Learning: documents have a quality label, their lines have none. All lines of a good document
   are good. Those of a bad one start as bad; after a fit, a line of a bad document is bad if its
   marginal is one half or more, or if none of its document's reaches that and it is the largest; so
   ``ROUNDS`` times. The first fit sees each line alone (else every line near a bad one would stay
   bad), the others are of the whole chain. A fit is gradient ascent on the conditional likelihood of the
   tags, with expectations by forward-backward.
3. Scoring: the marginals of the tag bad, weighted by the lines' lengths, give the bad share and the
   bad bytes of a document; with the largest marginal they go through a logistic layer fitted on the
   same sample. Lines with a marginal of one half or more are the ones reported.

The sample is ``SAMPLE_ROWS`` documents of each label, chosen by hash from the labelled documents
that are not held out, with at most ``SAMPLE_LINES`` lines each (of a longer one a run of so many).
labels, lang, source and doc_id are never inputs of a score.

Defined results: null and empty texts have no lines, lines without a word are never bad, and a text
without any word gets the score of one without a bad line;
null labels are not learned from, a document labelled several times is bad if any label says so,
labels of absent documents count for nothing; if no good or no bad learning document is there, every
score is 1; a null doc_id is not held out and joins no label; equal rows are sampled once; every
input row gives one output row; an input column named like an output column gives way."""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, per_document, texts_of
from .language_id import held_out

SAMPLE_ROWS = 500
SAMPLE_LINES = 200
FOLDS, FOLD = 3, 1
ROUNDS = 3
#: Steps, step size and ridge penalty of a fit of the chain.
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
#: Lines of the pieces that longer documents are fitted in.
PIECE = 16
#: Documents are walked together as long as their padded lines are not more than this.
PADDED = 1 << 18

_UPPER = bytes(range(0x41, 0x5B))
_LETTER = _UPPER + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_DIGIT = bytes(range(0x30, 0x3A))
_MARK = b".,;:'\"-?!()"
_SPACE = b" \t\r\v\f"
OWN = 10


# -- lines ---------------------------------------------------------------------------------

def share(line: bytes, kind: bytes) -> float:
    return 1 - len(line.translate(None, kind)) / len(line)


def described(line: bytes, seen: set[bytes]) -> tuple:
    """The ``OWN`` values of one line; ``seen`` are the lines before it."""
    words = line.split()
    n = len(words)
    letters = share(line, _LETTER)
    marks, digits = share(line, _MARK), share(line, _DIGIT)
    symbols = max(0.0, 1 - letters - marks - digits - share(line, _SPACE))
    return (letters, share(line, _UPPER), digits, symbols, share(line, b"!?"), 1 - len(set(words)) / n,
            sum(map(operator.eq, words, words[1:])) / n, min(1.0, len(line) / n / 20), np.log1p(len(line)) / 10,
            float(line in seen))


def lines_of(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of the lines with a word: values (own, those of the one before, those of the one behind),
    bytes and line number; and the number of all lines."""
    every = text.split(b"\n") if text else []
    lines = [(k, line) for k, line in enumerate(every) if line and not line.isspace()]
    seen: set[bytes] = set()
    own = np.zeros((len(lines) + 2, OWN))
    for row, (_, line) in enumerate(lines, 1):
        own[row] = described(line, seen)
        seen.add(line)
    return (np.concatenate((own[1:-1], own[:-2], own[2:]), 1), np.array([len(x) for _, x in lines], float),
            np.array([k for k, _ in lines], np.int32), len(every))


# -- the chain -----------------------------------------------------------------------------

def padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of different lengths as one, and the mask of what is there."""
    size = np.array([len(p) for p in parts])
    mask = np.arange(size.max(initial=0)) < size[:, None]
    out = np.zeros((*mask.shape, *parts[0].shape[1:]))
    out[mask] = np.concatenate(parts)
    return out, mask


def forward_backward(emission: np.ndarray, mask: np.ndarray, moves: np.ndarray):
    """Marginals of the tag bad, and of the four tag pairs of neighbouring lines, from the
    log-potentials of bad (documents x lines) and of the moves good-bad, bad-good, bad-bad."""
    step = np.exp(np.array([[0.0, moves[0]], [moves[1], moves[2]]]))
    emit = np.stack([np.ones(mask.shape), np.exp(np.clip(emission, -30, 30))], -1)
    n, width = mask.shape
    alpha, beta = np.ones((n, width, 2)) / 2, np.ones((n, width, 2)) / 2
    for k in range(width):
        a = emit[:, k] * (alpha[:, k - 1] @ step if k else 1.0)
        alpha[:, k] = np.where(mask[:, k, None], a / a.sum(1, keepdims=True), 0.5)
    for k in range(width - 2, -1, -1):
        b = (emit[:, k + 1] * beta[:, k + 1]) @ step.T
        beta[:, k] = np.where(mask[:, k + 1, None], b / b.sum(1, keepdims=True), 0.5)
    p = alpha * beta
    p = p[..., 1] / p.sum(-1) * mask
    pair = alpha[:, :-1, :, None] * step * (emit * beta)[:, 1:, None, :]
    pair = pair / pair.sum((2, 3), keepdims=True) * mask[:, 1:, None, None]
    return p, pair


def scaled(values: np.ndarray, center: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return (values - center) / spread


class Chain:
    """``weights``: one for a bad line's bias, one for each value, three for the moves."""

    def __init__(self, center, spread, weights):
        self.center, self.spread, self.weights = center, spread, weights

    def emission(self, values: np.ndarray) -> np.ndarray:
        return self.weights[0] + scaled(values, self.center, self.spread) @ self.weights[1:-3]

    def marginals(self, values: list[np.ndarray]) -> list[np.ndarray]:
        """Of every document's lines; documents of like length are walked together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(values)
        order = sorted((k for k, v in enumerate(values) if len(v)), key=lambda k: len(values[k]))
        while order:
            most = max(1, PADDED // len(values[order[-1]]))
            group, order = order[-most:], order[:-most]
            emission, mask = padded([self.emission(values[k]) for k in group])
            p, _ = forward_backward(emission, mask, self.weights[-3:])
            for row, k in enumerate(group):
                out[k] = p[row, :len(values[k])]
        return out


def fit_chain(values: list[np.ndarray], tags: list[np.ndarray], alone: bool = False) -> Chain:
    """``alone``: lines are judged by their own values, without neighbours and moves."""
    every = np.concatenate(values)
    center, spread = every.mean(0), every.std(0) + 1e-3
    x, mask = padded([scaled(v[k:k + PIECE], center, spread) for v in values for k in range(0, len(v), PIECE)])
    y = padded([t[k:k + PIECE].astype(float) for t in tags for k in range(0, len(t), PIECE)])[0]
    pair = mask[:, 1:]
    before, behind = y[:, :-1][pair], y[:, 1:][pair]
    seen = np.concatenate(([y.sum()], (y[..., None] * x).sum((0, 1)), [
        ((1 - before) * behind).sum(), (before * (1 - behind)).sum(), (before * behind).sum()]))
    weights, count = np.zeros(len(seen)), mask.sum()
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    free = np.arange(len(seen)) <= (OWN if alone else len(seen))
    for k in range(1, STEPS + 1):
        p, pairs = forward_backward(weights[0] + x @ weights[1:-3], mask, weights[-3:])
        expected = np.concatenate(([p.sum()], (p[..., None] * x).sum((0, 1)), pairs.sum((0, 1))[[0, 1, 1], [1, 0, 1]]))
        slope = ((seen - expected) / count - RIDGE * weights) * free
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        weights = weights + RATE * first / (1 - 0.9 ** k) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-6)
    return Chain(center, spread, weights)


def summary(p: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
    """Per document: 1, the share of its bytes that is bad, the bad bytes (log), the largest marginal."""
    bad = np.array([float(a @ b) for a, b in zip(p, sizes)])
    total = np.array([b.sum() for b in sizes])
    return np.stack([np.ones(len(p)), bad / np.maximum(total, 1), np.log1p(bad) / 10,
                     np.array([a.max(initial=0.0) for a in p])], 1)


def fit_layer(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - q) - 1e-2 * w
        w = w + np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(len(w)), slope)
    return w


# -- learning and scoring ------------------------------------------------------------------

def learning_labels(labels: DataFrame) -> DataFrame:
    return (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", FOLDS, FOLD))
            .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality")))


def sample_lines(rows: DataFrame) -> DataFrame:
    """(quality, values of the lines one after the other, bytes of the lines) of each sampled text."""
    def run(batches):
        for batch in batches:
            values, sizes = [], []
            for text in texts_of(batch):
                v, size, _, _ = lines_of(text)
                if len(v) > SAMPLE_LINES:
                    first = len(v) * 0x9E3779B1 % (len(v) - SAMPLE_LINES + 1)
                    v, size = v[first:first + SAMPLE_LINES], size[first:first + SAMPLE_LINES]
                values.append(v.ravel())
                sizes.append(size)
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(values, pa.list_(pa.float64())), pa.array(
                sizes, pa.list_(pa.float64()))], names=["quality", "values", "sizes"])

    return batched(rows, run, "quality int, values array<double>, sizes array<double>")


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Chain, np.ndarray] | None:
    """The chain and the logistic layer, or None where a label is missing."""
    name = F.xxhash64("doc_id", "text").alias("h")
    labelled = docs.select("doc_id", name).join(learning_labels(labels), "doc_id").select("h", "quality").distinct()
    chosen = [r for q in (0, 1) for r in labelled.where(F.col("quality") == q).orderBy("h").limit(SAMPLE_ROWS).collect()]
    if {r.quality for r in chosen} != {0, 1}:
        return None
    picked = docs.sparkSession.createDataFrame([(r.h, r.quality) for r in chosen], "h long, quality int")
    rows = (docs.select(name, "text").join(F.broadcast(picked), "h")  # 2 x SAMPLE_ROWS hashes
            .groupBy("h", "quality").agg(F.first("text").alias("text")).orderBy("h"))
    values, sizes, good = [], [], []
    for r in sample_lines(rows.select("quality", "text")).collect():  # 2 x SAMPLE_ROWS rows of SAMPLE_LINES lines
        values.append(np.array(r["values"], float).reshape(-1, 3 * OWN))
        sizes.append(np.array(r.sizes, float))
        good.append(r.quality)
    good = np.array(good)
    with_lines = [k for k, v in enumerate(values) if len(v)]
    if {int(good[k]) for k in with_lines} != {0, 1}:
        return None
    tags = [np.full(len(v), q == 0) for v, q in zip(values, good)]
    for left in range(ROUNDS, 0, -1):
        chain = fit_chain([values[k] for k in with_lines], [tags[k] for k in with_lines], left == ROUNDS)
        p = chain.marginals(values)
        if left > 1:
            tags = [(a >= 0.5) | (a >= a.max(initial=1e-9)) if q == 0 else np.zeros(len(a), bool) for a, q in zip(p, good)]
    return chain, fit_layer(summary(p, sizes), good.astype(float))


SCHEMA = "score double, predicted int, n_lines long, n_bad long, bad array<int>"


def score_quality(docs: DataFrame, labels: DataFrame, keep: bool = False, model=None) -> DataFrame:
    """Score of every whole text (1: good), 1 where it is at least one half, its lines, and the
    numbers (from 0) of the lines labelled bad."""
    model = model or learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def score(texts):
            if not model or not texts:
                n = len(texts)
                lines = [len(t.split(b"\n")) if t else 0 for t in texts]
                return [pa.array([1.0] * n, pa.float64()), pa.array([1] * n, pa.int32()), pa.array(lines, pa.int64()),
                        pa.array([0] * n, pa.int64()), pa.array([[]] * n, pa.list_(pa.int32()))]
            chain, layer = model
            values, sizes, at, n_lines = zip(*map(lines_of, texts))
            p = chain.marginals(list(values))
            score = 1 / (1 + np.exp(-np.clip(summary(p, list(sizes)) @ layer, -30, 30)))
            bad = [k[a >= 0.5] for a, k in zip(p, at)]
            return [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                    pa.array(n_lines, pa.int64()), pa.array([len(b) for b in bad], pa.int64()),
                    pa.array(bad, pa.list_(pa.int32()))]

        return score

    return per_document(docs, SCHEMA, make, keep)
