"""Operator 5: removal of passages that an earlier document has, by a count-min prefilter.

First pass: every task sketches the anchors of its documents' windows; the merged sketch
overestimates in how many documents an anchor, and so each of its windows, occurs. Second pass:
only blocks whose anchor the sketch counts at least twice are grouped exactly: by context, and
where one anchor has several contexts by window. No repeated window is lost, since a window's
count never exceeds its anchor's estimate. Windows are compared by 96-bit hashes.

The broadcast sketch has a fixed size (see ``sketch``). Over a corpus that fills it the second
pass groups all blocks (about one for 13 words), which costs more shuffle and changes no result.

A word goes if it lies in a window whose words also start in a document of smaller doc_id.
Defined results: null and empty texts have no words; rows with a null doc_id are neither
searched nor changed; rows that share a doc_id do not count as smaller than each other, so
repeated rows stay alike; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import covered, scratch, space_words, texts_of, word_hashes, written
from .sketch import repeated_bitmap
from .spans import CONTEXT, KEY, Blocks, blocks_to_compare, flagged_blocks, keyed, leading_blocks, rewrite, windows_at

#: Words of a window; words of the pieces whose least hash is a window's anchor.
WINDOW = 50
GRAM = 26


def symbols(text: bytes) -> np.ndarray:
    return word_hashes(space_words(text))


def sketched(docs: DataFrame, window: int, gram: int) -> np.ndarray:
    """First pass: bitmap of the anchors that may occur in several documents."""
    return repeated_bitmap(keyed(docs), lambda batch: [
        np.unique(Blocks(symbols(t), window, gram).anchor) for t in texts_of(batch)])


def repeated_places(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Stretches of windows (KEY, first, n) that also start in a document of smaller doc_id."""
    with scratch():
        bitmap = sketched(docs, window, gram)
        blocks = written(flagged_blocks(docs, bitmap, symbols, window, gram), "blocks")
        leaders = written(leading_blocks(blocks), "leaders")
        again = blocks.join(leaders.where("size > 1").select(*CONTEXT, "lead"), CONTEXT)
        whole = again.where(F.col("doc_id") > F.col("lead.doc_id")).select(*KEY, "first", "n")
        edges = written(blocks_to_compare(leaders), "edges")
        windows = written(windows_at(docs, edges, symbols, window), "windows")
        least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        single = written(windows.join(least.where("least < most").drop("most"), ["h1", "h2"]).where("doc_id > least")
                         .select(*KEY, "first", "block"), "single")
        # further blocks of a context under the leader's doc_id lose what the leader loses, at the same offsets
        beside = again.where((F.col("doc_id") == F.col("lead.doc_id")) & ~(
            (F.col("text_key") == F.col("lead.text_key")) & (F.col("first") == F.col("lead.first"))))
        beside = beside.select("doc_id", F.col("lead.text_key").alias("text_key"), F.col("lead.first").alias("block"),
                               F.col("text_key").alias("own_key"), F.col("first").alias("own_first")).distinct()
        copied = single.join(beside, [*KEY, "block"]).select(
            "doc_id", F.col("own_key").alias("text_key"), (F.col("own_first") + F.col("first") - F.col("block")).alias("first"))
        single = single.select(*KEY, "first").union(copied).withColumn("n", F.lit(window))
        return written(whole.select(*KEY, "first", (F.col("n") + (window - 1)).alias("n")).union(single), "places",
                       stays=True)


def dedup_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep: bool = False) -> DataFrame:
    """n_words, n_removed and kept_sha256 of every row; with ``keep`` all columns, the text of a
    changed row being its kept words joined by one space."""
    def make(text, starts, lengths):
        words = space_words(text)
        gone = covered(starts, lengths, len(words)) if len(starts) else np.zeros(len(words), bool)
        left = [w for w, g in zip(words, gone) if not g] if gone.any() else words
        joined = b" ".join(left)
        out = (len(words), int(gone.sum()), hashlib.sha256(joined).hexdigest())
        return (joined if out[1] else text, *out) if keep else out

    return rewrite(docs, repeated_places(docs, window, gram), "n_words long, n_removed long, kept_sha256 string",
                   make, keep)
