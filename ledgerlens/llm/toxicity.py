"""Operator 8: toxicity by a linear-chain conditional random field over words.

1. Corpus statistics (Spark, all learning rows): in how many toxic and clean labelled documents
   each word and each word beginning (stem) occurs. Those whose log-odds of toxicity are
   significantly positive form the lexicon; a word takes the largest odds of itself and its stems,
   so entries that a shorter stem of at least their odds stands for are left out. All others stay:
   a lexicon above LEXICON_BYTES is not broadcast but joined with the words of the texts.
2. Labelled tokens: a lexicon word of a toxic document is tagged offending, every other word is
   not. A two-tag chain (emissions from a word's log-odds, tag transitions) is fitted to a bounded
   sample by gradient ascent on the conditional likelihood.
3. Scoring: forward-backward marginals of the offending tag on the whole text. A word outside the
   lexicon has constant potentials, so a run of n such words is one closed-form matrix power and
   the chain is walked over lexicon words only, for all documents of a batch at once.
4. The marginals of a text (their sum, density and largest) go through a logistic layer fitted on
   the same sample; words with a marginal of at least one half are the offending ones, reported
   as byte offsets.

Labels are learned only from rows that are not held out; labels, lang, source and doc_id are
never inputs of a score.

Defined results: null and empty texts have no words and get the score of a text without lexicon
words; labels that are null are not learned from, and a document labelled several times counts
as toxic if any label says so; labels of documents that are not there count for nothing, equal
rows are sampled once; if there is no toxic or no clean learning document, every score is 0;
a null doc_id is not held out and joins no label; every input row gives one output row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, free_name, per_document, texts_of, word_hashes, written
from .language_id import held_out
from .sketch import maybe_repeated, repeated_bitmap
from .spans import row_bitmap, texts_with

#: Documents of each label in the sample that fits the chain and the logistic layer.
SAMPLE_ROWS = 500
#: Words of one text of the sample; a longer one is learned from in a run of so many.
SAMPLE_WORDS = 20_000
#: A lexicon word occurs in this many toxic learning documents at least, and its log-odds lie
#: this many standard errors above zero.
LEAST_TOXIC, SIGNIFICANT, LEAST_ODDS = 4, 4.0, 1.5
#: Bytes of a lexicon (its words and so many a word besides) up to which it is broadcast.
LEXICON_BYTES, ENTRY_BYTES = 32 << 20, 160
#: Parts of each lexicon word where the lexicon is joined, so that a frequent one is spread.
SALT = 16
FOLDS, FOLD = 5, 0
#: Entries a task counts before it hands them on.
HELD = 500_000
#: Weight of the ridge penalty, steps and step size of the gradient ascent.
RIDGE, STEPS, RATE = 1e-3, 150, 0.5

#: Column of a text's own lexicon entries, where the lexicon is joined.
LISTED = "_listed"
#: Lengths (bytes) of the word beginnings counted next to whole words; a stem is marked by a star.
STEMS = (5, 6, 7, 8)

_WORD = regex.compile(rb"[a-z0-9\x80-\xff]+")
_LOWER = bytes((b + 32) if 0x41 <= b <= 0x5A else b for b in range(256))


def words_at(text: bytes | None) -> tuple[list[bytes], list[int]]:
    found = list(_WORD.finditer(text.translate(_LOWER))) if text else []
    return [m.group() for m in found], [m.start() for m in found]


def entries(word: bytes) -> list[bytes]:
    """Lexicon entries that speak for a word."""
    return [word, *(word[:k] + b"*" for k in STEMS if len(word) >= k)]


def covering(entry: bytes) -> list[bytes]:
    """Shorter stems, which speak for every word that the entry speaks for."""
    core = entry.removesuffix(b"*")
    return [x for k in STEMS if k <= len(core) and (x := core[:k] + b"*") != entry]


class Odds(dict):
    """word -> its odds by the lexicon, 0 for a plain word (a bounded memo)."""

    def __init__(self, lexicon: dict[bytes, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 1 << 18:
            self.clear()
        odds = self[word] = max(self.lexicon.get(e, 0.0) for e in entries(word))
        return odds


# -- corpus statistics ---------------------------------------------------------------------

def learning_labels(labels: DataFrame) -> DataFrame:
    return (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .where(~held_out("doc_id", FOLDS, FOLD))
            .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))


def word_sets(rows: DataFrame) -> DataFrame:
    """(word, toxic, documents), summed over up to ``HELD`` entries before they leave Python."""
    def table(counts):
        return pa.RecordBatch.from_arrays([
            pa.array([w for w, _ in counts], pa.binary()), pa.array([t for _, t in counts], pa.int32()),
            pa.array(list(counts.values()), pa.int64())], names=["word", "toxic", "n"])

    def run(batches):
        counts: dict[tuple[bytes, int], int] = {}
        for batch in batches:
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                for word in {e for w in set(words_at(text)[0]) for e in entries(w)}:
                    counts[word, toxic] = counts.get((word, toxic), 0) + 1
                if len(counts) >= HELD:
                    yield table(counts)
                    counts = {}
        if counts:
            yield table(counts)

    return batched(rows, run, "word binary, toxic int, n long")


def without_covered(kept: DataFrame) -> DataFrame:
    """The entries (word, odds) that no shorter stem of at least their odds stands for."""
    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            stems = [covering(w) for w in words]
            row = pa.array([k for k, x in enumerate(stems) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("word").take(row), batch.column("odds").take(row), pa.array(
                [x for found in stems for x in found], pa.binary())], names=["covered", "least", "word"])

    covered = batched(kept, run, "covered binary, least double, word binary").join(kept, "word").where("odds >= least")
    return kept.join(covered.select(F.col("covered").alias("word")).distinct(), "word", "left_anti")


def lexicon(rows: DataFrame) -> dict[bytes, float] | DataFrame:
    """Significantly toxic words and their log-odds, over all learning rows; above LEXICON_BYTES
    as a table (word, odds)."""
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = word_sets(rows).groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (bad - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (good - F.col("c") + 0.5))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    kept = written(counts.where(F.col("t") >= LEAST_TOXIC).select("word", odds.alias("odds"), (odds / error).alias("z"))
                   .where((F.col("z") >= SIGNIFICANT) & (F.col("odds") >= LEAST_ODDS)).drop("z"), "significant")
    kept = written(without_covered(kept), "lexicon")
    size = kept.agg(F.sum(F.octet_length("word") + ENTRY_BYTES)).first()[0] or 0
    return {bytes(r.word): float(r.odds) for r in kept.collect()} if size <= LEXICON_BYTES else kept


def with_listed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` and, as a last column, the lexicon entries (word, odds) that speak for words of the
    text, null for none. Only entries that a bitmap of the lexicon may hold are shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(repeated_bitmap(
        table.select("word"), lambda batch: [np.repeat(word_hashes(batch.column("word").to_pylist()), 2)]))

    def run(batches):
        for batch in batches:
            found = []
            for text in texts_of(batch):
                words = list({e for w in set(words_at(text)[0]) for e in entries(w)})
                kept = np.flatnonzero(maybe_repeated(word_hashes(words), shared.value)) if words else ()
                found.append([words[k] for k in kept])
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([batch.column("_key").take(row), pa.array(
                [w for x in found for w in x], pa.binary())], names=["_key", "word"])

    key, listed_name = free_name(rows, "_key"), free_name(rows, LISTED)
    keyed = rows.withColumn(key, F.md5("text"))
    salt = F.pmod(F.xxhash64("_key"), F.lit(SALT)).cast("int").alias("salt")
    words = batched(keyed.select(F.col(key).alias("_key"), "text").where("text is not null"), run,
                    "_key string, word binary").distinct()
    parts = table.select("word", "odds", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    listed = (words.select("_key", "word", salt).join(parts, ["word", "salt"])
              .groupBy(F.col("_key").alias(key)).agg(F.collect_list(F.struct("word", "odds")).alias(listed_name)))
    return keyed.join(listed, key, "left").drop(key)


def own_odds(listed: list | None) -> Odds:
    return Odds({bytes(x["word"]): x["odds"] for x in listed or ()})


# -- the chain -----------------------------------------------------------------------------

class Chain:
    """Two tags (0 plain, 1 offending). ``weights``: emission of tag 1 for a plain word, for a
    lexicon word and for each unit of its log-odds; transitions 01, 10 and 11 over 00."""

    def __init__(self, weights):
        self.weights = np.asarray(weights, float)
        plain, _, _, t01, t10, t11 = self.weights
        self.step = np.exp(np.array([[0.0, t01], [t10, t11]]))
        neutral = self.step * np.exp(np.array([0.0, plain]))  # transition into a plain word
        values, vectors = np.linalg.eig(neutral)
        order = np.argsort(-values.real)
        values, vectors = values.real[order], vectors.real[:, order]
        inverse = np.linalg.inv(vectors)
        self.parts = [np.outer(vectors[:, k], inverse[k]) for k in (0, 1)]
        self.ratio = values[1] / values[0]

    def run(self, n: np.ndarray) -> np.ndarray:
        """n plain words in a row as a matrix, divided by the n-th power of the larger eigenvalue."""
        out = self.parts[0] + (self.ratio ** n.astype(float))[:, None, None] * self.parts[1]
        return np.where((n == 0)[:, None, None], np.eye(2), out)

    def emission(self, odds: np.ndarray) -> np.ndarray:
        return np.exp(self.weights[1] + self.weights[2] * odds)

    def marginals(self, odds: list[np.ndarray], places: list[np.ndarray], sizes: np.ndarray):
        """Marginals of the offending tag at the lexicon words of several texts: padded array
        (texts x words) and its mask. ``places`` are word positions, ``sizes`` numbers of words."""
        n = np.array([len(o) for o in odds])
        width = int(n.max(initial=0))
        mask = np.arange(width) < n[:, None]
        x, at = np.zeros(mask.shape), np.zeros(mask.shape, np.int64)
        if width:
            x[mask], at[mask] = np.concatenate(odds), np.concatenate(places)
        emit = np.stack([np.ones(mask.shape), self.emission(x)], -1)
        alpha = np.zeros((*mask.shape, 2))
        state, place = np.ones((len(n), 2)) / 2, np.full(len(n), -1)
        for k in range(width):  # as many steps as the text with most lexicon words has of them
            gap = self.run(np.maximum(at[:, k] - place - 1, 0)) @ self.step
            new = np.einsum("bi,bij->bj", state, gap) * emit[:, k]
            new /= new.sum(1, keepdims=True)
            live = mask[:, k]
            state, place = np.where(live[:, None], new, state), np.where(live, at[:, k], place)
            alpha[:, k] = state
        beta, back, place = np.zeros_like(alpha), np.ones((len(n), 2)), sizes.astype(np.int64)
        pending = np.ones((len(n), 2))  # emission times beta of the next lexicon word
        first = np.ones(len(n), bool)
        for k in range(width - 1, -1, -1):
            live = mask[:, k]
            gap = self.run(np.maximum(place - at[:, k] - 1, 0))
            ahead = np.einsum("bij,bj->bi", gap, np.where(first[:, None], 1.0, pending @ self.step.T))
            back = ahead / ahead.sum(1, keepdims=True)
            beta[:, k] = back
            pending = np.where(live[:, None], emit[:, k] * back, pending)
            place, first = np.where(live, at[:, k], place), first & ~live
        joint = alpha * beta
        total = joint.sum(-1)
        return np.where(mask, joint[..., 1] / np.where(total > 0, total, 1), 0.0), mask


def fit_chain(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Chain:
    """Gradient ascent on the log-likelihood of tagged word sequences (odds, tags): the gradient
    is observed minus expected feature counts, the expectations by forward-backward."""
    width = 64
    pieces = [(o[i:i + width], y[i:i + width]) for o, y in sequences for i in range(0, len(o), width)]
    pieces = [p for p in pieces if len(p[0])]
    if not pieces:
        return Chain(np.zeros(6))
    lengths = np.array([len(o) for o, _ in pieces])
    mask = np.arange(width) < lengths[:, None]
    x, y = np.zeros(mask.shape), np.zeros(mask.shape, np.int8)
    x[mask], y[mask] = np.concatenate([o for o, _ in pieces]), np.concatenate([t for _, t in pieces])
    listed = x > 0
    pair = mask[:, 1:]

    def emissions(p):
        return np.stack([(p * (mask & ~listed)).sum(), (p * listed).sum(), (p * listed * x).sum()])

    def transitions(q):  # q: (2, 2) totals
        return np.array([q[0, 1], q[1, 0], q[1, 1]])

    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][pair], y[:, 1:][pair]), 1)
    observed = np.concatenate([emissions(y * mask), transitions(seen)])
    count, weights, moment = mask.sum(), np.array([-4.0, 0.0, 0.5, -1.0, 0.0, 0.0]), np.zeros(6)
    for _ in range(STEPS):
        emit = np.stack([np.ones(mask.shape), np.exp(np.where(listed, weights[1] + weights[2] * x, weights[0]))], -1)
        step = np.exp(np.array([[0.0, weights[3]], [weights[4], weights[5]]]))
        alpha = np.zeros((*mask.shape, 2))
        a = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
        alpha[:, 0] = a
        for k in range(1, width):
            new = (a @ step) * emit[:, k]
            a = np.where(mask[:, k, None], new / new.sum(1, keepdims=True), a)
            alpha[:, k] = a
        beta, b = np.ones_like(alpha), np.ones((len(pieces), 2))
        expected = np.zeros((2, 2))
        for k in range(width - 1, -1, -1):
            beta[:, k] = b
            if k:
                ahead = emit[:, k] * b
                q = alpha[:, k - 1, :, None] * step * ahead[:, None, :]
                q /= q.sum((1, 2), keepdims=True)
                expected += q[mask[:, k]].sum(0)
                new = ahead @ step.T
                b = np.where(mask[:, k, None], new / new.sum(1, keepdims=True), b)
        p = alpha * beta
        p = (p / p.sum(-1, keepdims=True))[..., 1] * mask
        slope = (observed - np.concatenate([emissions(p), transitions(expected)])) / count - RIDGE * weights / 10
        moment = 0.9 * moment + 0.1 * slope * slope if moment.any() else slope * slope
        weights = weights + RATE * slope / (np.sqrt(moment) + 1e-4) * 0.2
    return Chain(weights)


# -- texts ---------------------------------------------------------------------------------

def listed_words(text: bytes | None, odds_of: Odds):
    """Odds, word positions and byte spans of the lexicon words of a text; its number of words."""
    words, starts = words_at(text)
    odds = np.fromiter(map(odds_of.__getitem__, words), float, len(words))
    at = np.flatnonzero(odds)
    return odds[at], at, [(starts[k], starts[k] + len(words[k])) for k in at], len(words)


def features(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = p.sum(1)
    return np.stack([np.ones(len(p)), np.log1p(total), p.max(1, initial=0.0),
                     np.log1p(100 * total / np.maximum(sizes, 1)), np.log1p(sizes) / 10 * (total > 0.05)], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
    return w


def labelled_texts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled documents. A bitmap of their ids keeps most other texts out of
    the shuffle; the join is by sort-merge at every size of the labels."""
    shared = docs.sparkSession.sparkContext.broadcast(row_bitmap(known.select(F.xxhash64("doc_id").alias("row"))))
    rows = texts_with(docs.select("doc_id", "text", F.xxhash64("doc_id").alias("_row")), shared)
    return rows.join(known.hint("merge"), "doc_id").select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame):
    """(lexicon, chain weights, logistic weights), or None where a label is missing."""
    known = learning_labels(labels)
    labelled = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).join(known, "doc_id")
    odds_of = lexicon(labelled_texts(docs, known))
    # the sample is taken from labelled documents, by hash; equal rows count once
    chosen = [r for t in (0, 1) for r in labelled.where(F.col("toxic") == t).select("h", "toxic").distinct()
              .orderBy("h").limit(SAMPLE_ROWS).collect()]
    if not {r.toxic for r in chosen} == {0, 1}:
        return None
    picked = docs.sparkSession.createDataFrame([(r.h, r.toxic) for r in chosen], "h long, toxic int")
    spark_rows = (docs.select(F.xxhash64("doc_id", "text").alias("h"), "text")
                  .join(F.broadcast(picked), "h")  # 2 x SAMPLE_ROWS hashes
                  .groupBy("h", "toxic").agg(F.first("text").alias("text")).select("text", "toxic"))
    tagged, rows = [], []
    for r in sample_words(spark_rows, odds_of).collect():  # 2 x SAMPLE_ROWS rows of lexicon words
        x, at = np.array(r.odds, float), np.array(r.at, np.int64)
        rows.append((x, at, r.n_words, r.toxic))
        odds = np.zeros(r.n_words)
        odds[at] = x
        tagged.append((odds, (odds > 0).astype(np.int8) * np.int8(r.toxic)))
    chain = fit_chain(tagged)
    sizes = np.array([n for _, _, n, _ in rows])
    p, _ = chain.marginals([x for x, *_ in rows], [at for _, at, *_ in rows], sizes)
    return odds_of, chain.weights, fit_logistic(features(p, sizes), np.array([t for *_, t in rows], float))


def sample_run(odds: np.ndarray, at: np.ndarray, spans: list, n_words: int):
    """A text of the sample; of one with more than SAMPLE_WORDS words a run of so many, chosen by
    a hash of its length."""
    if n_words <= SAMPLE_WORDS:
        return odds, at, spans, n_words
    first = n_words * 0x9E3779B1 % (n_words - SAMPLE_WORDS + 1)
    inside = (at >= first) & (at < first + SAMPLE_WORDS)
    return odds[inside], at[inside] - first, spans, SAMPLE_WORDS


def sample_words(rows: DataFrame, odds_of: dict[bytes, float] | DataFrame) -> DataFrame:
    joined = isinstance(odds_of, DataFrame)
    rows = with_listed(rows, odds_of) if joined else rows
    shared = rows.sparkSession.sparkContext.broadcast(None if joined else odds_of)

    def run(batches):
        odds = None if joined else Odds(shared.value)
        for batch in batches:
            each = map(own_odds, batch.column(batch.num_columns - 1).to_pylist()) if joined else [odds] * batch.num_rows
            found = [sample_run(*listed_words(t, o)) for t, o in zip(texts_of(batch), each)]
            yield pa.RecordBatch.from_arrays([
                pa.array([f[0] for f in found], pa.list_(pa.float64())),
                pa.array([f[1] for f in found], pa.list_(pa.int64())),
                pa.array([f[3] for f in found], pa.int64()), batch.column("toxic")],
                names=["odds", "at", "n_words", "toxic"])

    return batched(rows, run, "odds array<double>, at array<long>, n_words long, toxic int")


SCHEMA = "score double, predicted int, n_offending int, offending array<struct<first: int, until: int>>"


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: bool = False, model=None) -> DataFrame:
    """Score of every whole text, 1 where it is at least one half, and the byte spans of the
    words whose marginal is at least one half."""
    model = model or learn(docs, labels)
    joined = bool(model) and isinstance(model[0], DataFrame)
    shared = docs.sparkSession.sparkContext.broadcast((None, *model[1:]) if joined else model)

    def make():
        model = shared.value
        span = pa.list_(pa.struct([("first", pa.int32()), ("until", pa.int32())]))
        if model:
            odds_of, chain, layer = Odds(model[0] or {}), Chain(model[1]), model[2]

        def score(texts, listed=None):
            n = len(texts)
            if not model or not n:
                return [pa.array([0.0] * n, pa.float64()), pa.array([0] * n, pa.int32()),
                        pa.array([0] * n, pa.int32()), pa.array([[]] * n, span)]
            each = [odds_of] * n if listed is None else map(own_odds, listed)
            found = [listed_words(t, o) for t, o in zip(texts, each)]
            sizes = np.array([f[3] for f in found])
            p, mask = chain.marginals([f[0] for f in found], [f[1] for f in found], sizes)
            z = features(p, sizes) @ layer
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            spans = [[{"first": a, "until": b} for k, (a, b) in enumerate(f[2]) if p[i, k] >= 0.5]
                     for i, f in enumerate(found)]
            return [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                    pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, span)]

        return score

    if joined:
        rows = with_listed(docs, model[0])
        return per_document(rows, SCHEMA, make, keep, rows.columns[-1])
    return per_document(docs, SCHEMA, make, keep)
