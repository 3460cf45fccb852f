"""Operator 6: benchmark decontamination.

The benchmark's normalised word windows (13 words; a shorter item is one window) become a hash
set that is broadcast. A document is scanned in one pass: words outside the benchmark's
vocabulary break it into stretches, windows inside a stretch are looked up by their exact word
ids, and the words of all hits are marked.

The hash set is built from blocks of the benchmark of at most ``BLOCK_BYTES`` of text each;
a benchmark above that is scanned block by block, the hits so far travelling with the rows
through a written table, so that a worker never holds more than one block.

Defined results: null and empty texts and items have no words; an item with a null item_id
marks words but is not listed; a repeated item counts once; a null doc_id is carried through;
every input row gives one output row; an empty benchmark marks nothing."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, covered, free_name, per_document, plain_words, remaining, texts_of, written

#: Most benchmark text (bytes) in one broadcast hash set.
BLOCK_BYTES = 1 << 20
WINDOW = 13


class WindowSet:
    """Exact word windows of some items: word ids, and the items of each window by its ids."""

    def __init__(self, items, window: int):
        self.words: dict[bytes, int] = {}
        self.items: dict[int, dict[bytes, set[str]]] = {}
        for item_id, text in items:
            words = plain_words(text)
            if not words:
                continue
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words], np.int32)
            length = min(window, len(ids))
            found = self.items.setdefault(length, {})
            for s in range(len(ids) - length + 1):
                entry = found.setdefault(ids[s:s + length].tobytes(), set())
                if item_id is not None:
                    entry.add(str(item_id))

    def scan(self, words: list[bytes]) -> tuple[list[int], list[int], set[str]]:
        """Starts and lengths of all windows that occur among the words, and their items."""
        known = self.words.get
        ids = np.fromiter((known(w, 0) for w in words), np.int32, len(words))
        inside = np.concatenate(([0], np.cumsum(ids > 0)))
        starts, lengths, items = [], [], set()
        for length, windows in self.items.items():
            if length > len(ids):
                continue
            for s in np.flatnonzero(inside[length:] - inside[:-length] == length).tolist():
                entry = windows.get(ids[s:s + length].tobytes())
                if entry is not None:
                    starts.append(s)
                    lengths.append(length)
                    items |= entry
        return starts, lengths, items


def blocks(benchmark: DataFrame):
    """The benchmark in blocks of about ``BLOCK_BYTES`` of text: (rows, whether it is the last)."""
    rows = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).dropDuplicates()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(size) // BLOCK_BYTES
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield ((r.item_id, None if r.text is None else bytes(r.text)) for r in part.toLocalIterator()), b == n - 1


def digest(n_words, starts, lengths, items, share: int):
    hit = covered(np.array(starts, np.int64), np.array(lengths, np.int64), n_words) if starts else np.zeros(0, bool)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).reshape(-1, 2).tolist()
    n_hit = int(hit.sum())
    joined = ",".join(sorted(items))
    return (n_words, n_hit, len(items), hashlib.sha256(joined.encode()).hexdigest(),
            n_hit > 0 and share * n_hit >= n_words, [{"first": a, "until": b} for a, b in edges])


SCHEMA = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "hits array<struct<first: int, until: int>>")
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(),
          pa.list_(pa.struct([("first", pa.int32()), ("until", pa.int32())]))]
_CARRY = ("found_starts", "found_lengths", "found_items")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20,
                       keep: bool = False) -> DataFrame:
    """Per document: its words, the words inside benchmark windows, the items they come from,
    whether ``share`` times the hit words reach its words, and the hit word runs."""
    spark = docs.sparkSession
    several, carry = False, [free_name(docs, c) for c in _CARRY]
    for items, last in blocks(benchmark):
        shared = spark.sparkContext.broadcast(WindowSet(items, window))
        if last and not several:
            break
        docs, several = _scan_block(docs, shared, carry, not several), True
        if last:
            return _finish(docs, carry, share, keep)
        docs = written(docs, "decontaminate")

    def make():
        windows = shared.value

        def score(texts):
            rows = []
            for text in texts:
                words = plain_words(text)
                rows.append(digest(len(words), *windows.scan(words), share))
            return [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(_KINDS), _KINDS)]

        return score

    return per_document(docs, SCHEMA, make, keep)


def _scan_block(docs: DataFrame, shared, carry: list[str], first: bool) -> DataFrame:
    fields = [T.StructField(c, T.ArrayType(k)) for c, k in zip(carry, (T.IntegerType(), T.IntegerType(), T.StringType()))]
    old = remaining(docs, carry)
    names = [f.name for f in old]
    kinds = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]

    def run(batches):
        windows = shared.value
        for batch in batches:
            found = [[], [], []]
            had = None if first else [batch.column(c).to_pylist() for c in carry]
            for k, text in enumerate(texts_of(batch)):
                starts, lengths, items = windows.scan(plain_words(text))
                if had:
                    starts, lengths, items = had[0][k] + starts, had[1][k] + lengths, items | set(had[2][k])
                for column, value in zip(found, (starts, lengths, sorted(items))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [
                pa.array(c, k) for c, k in zip(found, kinds)], names=names + carry)

    return batched(docs, run, T.StructType(old + fields))


def _finish(docs: DataFrame, carry: list[str], share: int, keep: bool) -> DataFrame:
    new = T.StructType.fromDDL(SCHEMA)
    old = [f for f in remaining(docs, new.fieldNames() + carry) if keep or f.name.lower() == "doc_id"]
    names = [f.name for f in old]

    def run(batches):
        for batch in batches:
            rows = [digest(len(plain_words(t)), s, n, set(i), share) for t, s, n, i in zip(
                texts_of(batch), *[batch.column(c).to_pylist() for c in carry])]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [
                pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(_KINDS), _KINDS)],
                names=names + new.fieldNames())

    return batched(docs, run, T.StructType(old + new.fields))
