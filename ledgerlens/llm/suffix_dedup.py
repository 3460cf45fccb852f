"""Operator 7: removal of repeated byte strings by a logarithmic family of suffix arrays.

``SuffixIndex`` keeps levels of doubling size. Documents come in batches. The suffixes of a
batch are sampled at content-chosen positions (the anchors of all its ``WINDOW``-byte strings,
about one byte in seventy; equal strings have their anchor at the same place, so no long match
is lost) and sorted by the hash of their first ``GRAM`` bytes: any fixed order puts equal
beginnings side by side, and a hash order has no hot ranges. A new batch is merge-scanned for
equal beginnings within itself and against every level; then it becomes level 0, and two levels
of one size merge into the next. A suffix is therefore rewritten once for each doubling.

Matched beginnings are only candidates: their blocks are then compared over their whole contexts,
and where contexts differ window by window, by 96-bit hashes of all ``WINDOW`` bytes.

A byte goes if it lies in a ``WINDOW``-byte string that also starts anywhere else.
Defined results: null and empty texts have no bytes; a null doc_id is an id like any other; every
row is a document of its own, so of repeated rows (equal id and text) each string of a window's
length starts elsewhere, too; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, covered, discard, mask_runs, scratch, signed, texts_of, written
from .sketch import repeated_bitmap
from .spans import CONTEXT, KEY, Blocks, blocks_to_compare, flagged_blocks, keyed, leading_blocks, rewrite, windows_at

WINDOW = 200
GRAM = 64
#: Batches that a whole table is added in.
BATCHES = 4
#: Parts of one anchor's entries in a level, so that a hot anchor is not one task's.
SALT = 16

_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)


def symbols(text: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(text, np.uint8)]


def suffixes(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, doc_id, first): the sampled suffixes of every document."""
    def run(batches):
        for batch in batches:
            anchors, firsts = [], []
            for text in texts_of(batch):  # of a text's blocks only these stay, not its symbols and sums
                b = Blocks(symbols(text), window, gram)
                anchors.append(b.anchor)
                firsts.append(b.first)
            row = pa.array(np.repeat(np.arange(len(anchors)), [len(a) for a in anchors]))
            yield pa.RecordBatch.from_arrays([
                signed(np.concatenate(anchors)), batch.column("doc_id").take(row),
                pa.array(np.concatenate(firsts), pa.int32())], names=["anchor", "doc_id", "first"])

    return batched(docs.select("doc_id", "text"), run, T.StructType([
        T.StructField("anchor", T.LongType()), docs.schema["doc_id"], T.StructField("first", T.IntegerType())]))


class SuffixIndex:
    """Levels of sorted suffixes; level k holds 2^k batches. ``matched`` are the tables of
    beginnings that the merge-scans found more than once. A level 0 is one sorted array for each
    task that made it; merged levels are dealt out by beginning, a hot one over ``SALT`` parts."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram
        self.levels: dict[int, DataFrame] = {}
        self.matched: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """``batch``: KEY and text of new documents."""
        new = written(suffixes(batch, self.window, self.gram).sortWithinPartitions("anchor", "doc_id", "first"), "suffixes")
        # one scan over the new array and all levels: a beginning that is new here and known
        # there, or new twice (rows of one beginning are combined before the shuffle)
        rows = new.select("anchor", F.lit(1).alias("n"), F.lit(0).alias("known"))
        for level in self.levels.values():
            rows = rows.union(level.select("anchor", F.lit(0), F.lit(1)))
        seen = rows.groupBy("anchor").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
        self.matched.append(written(seen.where("n > 1 or (n = 1 and known = 1)").select("anchor"), "matched"))
        k = 0
        while k in self.levels:
            parts = (self.levels.pop(k), new)
            spread = F.pmod(F.xxhash64("doc_id"), F.lit(SALT))
            new = written(parts[0].union(parts[1]).repartition("anchor", spread)
                          .sortWithinPartitions("anchor", "doc_id", "first"), "suffixes")
            for old in parts:
                discard(old)
            k += 1
        self.levels[k] = new

    def bitmap(self) -> np.ndarray:
        """Bitmap of all matched beginnings, of fixed size."""
        found = self.matched[0]
        for more in self.matched[1:]:
            found = found.union(more)
        return repeated_bitmap(found.distinct(), lambda batch: [
            np.repeat(batch.column("anchor").to_numpy().view(np.uint64), 2)])


def repeated_places(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """Stretches of bytes (KEY, first, n) of strings that start elsewhere too."""
    with scratch():
        rows = keyed(docs)
        # equal rows have one key: all their strings repeat
        twice = (rows.select(*KEY, F.octet_length("text").alias("n")).groupBy(*KEY).agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n"))
                 .where(f"c > 1 and n >= {window}").select(*KEY, F.lit(0).alias("first"), "n"))
        index = SuffixIndex(window, gram)
        for b in range(batches):
            index.add(rows.where(F.pmod(F.xxhash64(*KEY), F.lit(batches)) == b))
        bitmap = index.bitmap()
        for level in index.levels.values():  # this query's index is not kept
            discard(level)
        blocks = written(flagged_blocks(docs, bitmap, symbols, window, gram).distinct(), "blocks")
        leaders = written(leading_blocks(blocks), "leaders")
        whole = blocks.join(leaders.where("size > 1").select(*CONTEXT), CONTEXT, "left_semi").select(
            *KEY, "first", (F.col("n") + (window - 1)).alias("n"))
        edges = written(blocks_to_compare(leaders), "edges")
        # One shuffle of the windows, no table of them: with one block a context, a window comes once
        # for each context it lies in, and equal ones meet in a partition that spills.
        found = windows_at(docs, edges, symbols, window)
        same = W.partitionBy("h1", "h2")
        single = (found.withColumn("size", F.count(F.lit(1)).over(same)).where("size > 1")
                  .select(*KEY, "first", F.lit(window).alias("n")))
        return written(whole.union(single).union(twice), "places", stays=True)


def dedup_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, batches: int = BATCHES) -> DataFrame:
    """n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of every row."""
    def make(text, starts, lengths):
        raw = np.frombuffer(text or b"", np.uint8)
        gone = covered(starts, lengths, len(raw)) if len(starts) else np.zeros(len(raw), bool)
        return len(raw), int(gone.sum()), mask_runs(gone), hashlib.sha256(raw[~gone].tobytes()).hexdigest()

    # ids as text, so that a null one is a key, too; the own one comes back in the end
    named = docs.select(F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias("doc_id"), "text",
                        F.col("doc_id").alias("own_id"))
    found = rewrite(named, repeated_places(named, window, gram, batches),
                    "n_bytes long, n_removed long, n_spans long, kept_sha256 string", make, also=("own_id",))
    return found.select(F.col("own_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
