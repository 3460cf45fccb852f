"""Repeated windows by anchors: what substring dedup and suffix-array dedup share.

Every window of ``window`` symbols has an anchor, the least hash of its ``gram``-symbol pieces,
so equal windows have equal anchors. Consecutive windows with one anchor form a block; its
context is all symbols its windows cover. Two blocks with equal contexts repeat each other as a
whole, so only one block of each context needs its windows compared one by one. A window reaches
half of what it has besides the anchor to the left of it or to the right; so that is needed only
where the anchor with that much to its left, or to its right, occurs in another context too."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WIDE, batched, mix64, remaining, signed, sliding_min, texts_of
from .sketch import maybe_repeated, repeated_bitmap

#: Fields that name a text: its doc_id and its checksum (a doc_id may recur with other texts).
KEY = ["doc_id", "text_key"]
CONTEXT = ["anchor", "f1", "f2"]
#: Cells of the bitmap of texts with places.
TEXTS = 1 << 22
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and text of the rows that take part: those with an id and a text."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())


class Blocks:
    """Anchors, block starts and block ends (in windows) of one symbol sequence.

    The anchor of a window is the leftmost piece of the least hash, found by one running minimum
    over (upper half of the hash, position)."""

    def __init__(self, symbols: np.ndarray, window: int, gram: int):
        self.n = max(0, len(symbols) - window + 1)
        self.window, self.gram = window, gram
        self.symbols = symbols
        if not self.n:
            self.anchor = np.zeros(0, np.uint64)
            self.first = self.until = self.at = np.zeros(0, np.int64)
            return
        self.prefix = [WIDE[0].prefix(symbols)]
        piece = WIDE[0].windows(self.prefix[0], gram)
        ranked = (piece & _HIGH) | np.arange(len(piece), dtype=np.uint64)
        least = sliding_min(ranked, window - gram + 1)
        self.first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        self.until = np.append(self.first[1:], self.n)
        self.at = (least[self.first] & _LOW).astype(np.int64)
        self.anchor = piece[self.at]

    def _both(self) -> list[np.ndarray]:
        if len(self.prefix) == 1:
            self.prefix.append(WIDE[1].prefix(self.symbols))
        return self.prefix

    def contexts(self, chosen: np.ndarray) -> list[np.ndarray]:
        """Two independent hashes of the contexts of the chosen blocks."""
        lo, hi = self.first[chosen], self.until[chosen] + self.window - 1
        return [w.spans(p, lo, hi) for w, p in zip(WIDE, self._both())]

    def halves(self, chosen: np.ndarray, context: np.ndarray) -> list[np.ndarray]:
        """Hash of the anchor with half the rest of a window to its left, and to its right; where
        the context has not that much, a value of this context alone."""
        half = (self.window - self.gram + 1) // 2
        at, lo, hi = self.at[chosen], self.first[chosen], self.until[chosen] + self.window - 1
        left, right = at - half, at + self.gram + half
        out = []
        for ok, a, b, own in ((left >= lo, left, at + self.gram, np.uint64(1)), (right <= hi, at, right, np.uint64(2))):
            a, b = np.where(ok, a, at), np.where(ok, b, at + self.gram)
            out.append(np.where(ok, WIDE[0].spans(self.prefix[0], a, b) ^ own, mix64(context ^ own)))
        return out

    def hashes(self, starts: np.ndarray) -> list[np.ndarray]:
        """Two independent hashes of the windows at ``starts``."""
        return [w.spans(p, starts, starts + self.window) for w, p in zip(WIDE, self._both())]


def upper(values: np.ndarray) -> pa.Array:
    """The second hash, cut to 32 bits."""
    return pa.array((values >> np.uint64(32)).astype(np.uint32).view(np.int32), pa.int32())


def flagged_blocks(docs: DataFrame, bitmap: np.ndarray, symbols: Callable[[bytes], np.ndarray], window: int,
                   gram: int) -> DataFrame:
    """Blocks whose anchor the bitmap may hold: CONTEXT, KEY, first, n (windows), left, right."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bits = shared.value
        for batch in batches:
            size, columns = [], ([], [], [], [], [], [], [])
            for text in texts_of(batch):
                b = Blocks(symbols(text), window, gram)
                chosen = np.flatnonzero(maybe_repeated(b.anchor, bits)) if b.n else b.first
                size.append(len(chosen))
                if len(chosen):
                    one, two = b.contexts(chosen)
                    values = (b.anchor[chosen], one, two, b.first[chosen], b.until[chosen] - b.first[chosen],
                              *b.halves(chosen, one))
                    for column, value in zip(columns, values):
                        column.append(value)
            if sum(size):
                row = pa.array(np.repeat(np.arange(len(size)), size))
                anchor, one, two, first, n, left, right = map(np.concatenate, columns)
                yield pa.RecordBatch.from_arrays([
                    signed(anchor), signed(one), upper(two), batch.column("doc_id").take(row),
                    batch.column("text_key").take(row), pa.array(first, pa.int32()), pa.array(n, pa.int32()),
                    signed(left), signed(right)], names=[*CONTEXT, *KEY, "first", "n", "left", "right"])

    return batched(keyed(docs), run, T.StructType([
        T.StructField("anchor", T.LongType()), T.StructField("f1", T.LongType()), T.StructField("f2", T.IntegerType()),
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text_key", T.LongType()),
        T.StructField("first", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("left", T.LongType()), T.StructField("right", T.LongType())]))


def leading_blocks(blocks: DataFrame) -> DataFrame:
    """One block of each context (the least: that of the smallest doc_id) and their number."""
    return blocks.groupBy(*CONTEXT).agg(F.min(F.struct(*KEY, "first", "n", "left", "right")).alias("lead"),
                                        F.count(F.lit(1)).alias("size"))


def blocks_to_compare(leaders: DataFrame) -> DataFrame:
    """The leading blocks that may share single windows with another context."""
    sides = leaders.select("lead.*")
    again = [sides.groupBy(F.col(c).alias("side")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("side")
             for c in ("left", "right")]
    shared = again[0].union(again[1])
    listed = sides.select(*KEY, "first", "n", F.explode(F.array("left", "right")).alias("side"))
    return listed.join(shared, "side", "left_semi").select(*KEY, "first", "n").distinct()


def text_bitmap(places: DataFrame) -> np.ndarray:
    """Bitmap, of fixed size, of the texts that have places."""
    return row_bitmap(places.select(F.xxhash64(*KEY).alias("row")).distinct())


def row_bitmap(rows: DataFrame) -> np.ndarray:
    """Bitmap, of fixed size, of the hashes in the column ``row``."""
    return repeated_bitmap(rows, lambda batch: [np.repeat(batch.column("row").to_numpy().view(np.uint64), 2)], TEXTS)


def texts_with(rows: DataFrame, shared) -> DataFrame:
    """Rows (with a column ``_row``: hash of KEY) whose text the bitmap may hold, so that only
    these are shuffled; a full bitmap lets all pass, which costs shuffle and changes nothing."""
    def run(batches):
        for batch in batches:
            kept = maybe_repeated(batch.column("_row").to_numpy().view(np.uint64), shared.value)
            yield batch.filter(pa.array(kept))

    return batched(rows, run, rows.schema).drop("_row")


def windows_at(docs: DataFrame, places: DataFrame, symbols: Callable[[bytes], np.ndarray], window: int) -> DataFrame:
    """(h1, h2, doc_id, text_key, first, block) of every window in the given blocks (KEY, first, n);
    ``block`` is where the window's block starts."""
    id_type = docs.schema["doc_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(text_bitmap(places))
    rows = texts_with(keyed(docs).withColumn("_row", F.xxhash64(*KEY)), shared)
    joined = rows.join(packed(places), KEY).dropDuplicates(KEY)  # repeated rows are one text

    def run(batches):
        for batch in batches:
            sizes, starts, begins, one, two = [], [], [], [], []
            for text, spans in zip(texts_of(batch), batch.column("spans")):
                lo, n = unpacked(spans)
                at = np.unique(np.concatenate([np.arange(a, a + m) for a, m in zip(lo, n)]))
                h = Blocks(symbols(text), window, window).hashes(at)
                sizes.append(len(at))
                starts.append(at)
                begins.append((lo := np.sort(lo))[np.searchsorted(lo, at, "right") - 1])
                one.append(h[0])
                two.append(h[1])
            row = np.repeat(np.arange(len(sizes)), sizes)
            cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [signed(cat(one, np.uint64)), upper(cat(two, np.uint64)), batch.column("doc_id").take(pa.array(row)),
                 batch.column("text_key").take(pa.array(row)), pa.array(cat(starts, np.int64), pa.int32()),
                 pa.array(cat(begins, np.int64), pa.int32())], names=["h1", "h2", *KEY, "first", "block"])

    return batched(joined, run, T.StructType([
        T.StructField("h1", T.LongType()), T.StructField("h2", T.IntegerType()), T.StructField("doc_id", id_type),
        T.StructField("text_key", T.LongType()), T.StructField("first", T.IntegerType()),
        T.StructField("block", T.IntegerType())]))


def packed(places: DataFrame) -> DataFrame:
    """The places (KEY, first, n) of each text as one array; bounded by the text's length."""
    return places.groupBy(*KEY).agg(F.collect_list(
        F.shiftleft(F.col("first").cast("long"), 32) + F.col("n").cast("long")).alias("spans"))


def unpacked(spans: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    values = spans.values
    if values is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values = values.to_numpy()
    return values >> 32, values & 0xFFFFFFFF


def rewrite(docs: DataFrame, places: DataFrame, schema: str, make: Callable, keep: bool = False,
            also: tuple[str, ...] = ()) -> DataFrame:
    """Every input row with the places found in its text: ``make(text, starts, lengths)`` gives
    the new columns' values, with ``keep`` also the new text in front; the rows keep their other
    columns, without it doc_id and those named by ``also``. Texts without places are finished in the scan, only the others are shuffled."""
    new = T.StructType.fromDDL(schema)
    names = new.fieldNames()
    old = [f for f in remaining(docs, names) if keep or f.name.lower() == "doc_id" or f.name in also]
    kept = [f.name for f in old]
    kinds = [_arrow(f.dataType) for f in new.fields]
    held = [c for c in kept if c.lower() != "text"]
    text_name = next((c for c in kept if c.lower() == "text"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(text_bitmap(places))
    key = F.xxhash64("text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("row"), "text", F.col("doc_id").alias("_id"),
                       key.alias("_key"), F.xxhash64("doc_id", key).alias("_row"))

    def made(batch, results):
        columns = dict(zip(held, batch.column("row").flatten()))
        if keep:
            columns[text_name] = pa.array([None if m[0] is None else m[0].decode() for m in results], pa.string())
            results = [m[1:] for m in results]
        values = zip(*results) if results else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([columns[c] for c in kept] + [
            pa.array(list(v), k) for v, k in zip(values, kinds)], names=kept + names)

    def untouched(batches):
        none = np.zeros(0, np.int64)
        for batch in batches:
            other = batch.filter(pa.array(~maybe_repeated(batch.column("_row").to_numpy().view(np.uint64), shared.value)))
            yield made(other, [make(text, none, none) for text in texts_of(other)])

    def touched(batches):
        for batch in batches:
            yield made(batch, [make(t, *unpacked(spans)) for t, spans in zip(texts_of(batch), batch.column("spans"))])

    schema = T.StructType(old + new.fields)
    found = packed(places).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans")
    joined = texts_with(rows, shared).join(found, ["_id", "_key"], "left").select("row", "text", "spans")
    return batched(rows, untouched, schema).union(batched(joined, touched, schema))


def _arrow(kind: T.DataType) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
