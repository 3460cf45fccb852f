"""Operator 10: language identification by compression.

Every language gets a raw-content zstandard dictionary: a bounded, hash-chosen sample of its
learning rows, of any length, each text with its share of the dictionary's bytes. A text is compressed once with each dictionary; the smallest output names
the language, since a dictionary helps most where its strings recur. The margin between the
two smallest gives the score, and a narrow margin marks the answer as rejected.

Defined results: null text and text without a letter are ``und`` with score 0; equal rows (id,
language and text) are learned from once; if nothing can be
learned (an empty table, all lang null) every text is ``und``; a null doc_id is learned from and
scored like any row that is not held out; equal sizes go to the language first in order; every
input row gives one output row; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batched, per_document, texts_of

#: The learning sample: rows of each language, by smallest hash, and the bytes that one of them may
#: fill at least (more where a language has few rows).
SAMPLE_ROWS = 400
SAMPLE_MOST = 20_000
#: Bytes of each dictionary.
DICTIONARY = 112 * 1024
LEVEL = 6
#: A margin (share of the second smallest size) below this rejects the answer.
NARROW = 0.01
#: Bytes of margin that make the answer twice as likely as its rival.
HALVING = 2.0

_LETTER = regex.compile(r"\p{L}")
#: Keeps lower-case ASCII letters and all bytes of other characters; the rest becomes space.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def normal(text: str) -> bytes:
    """Lower case, ASCII digits and signs as single spaces: only the language is left to compare."""
    return b" ".join(text.lower().encode().translate(_LETTERS).split())


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2):
    """crc32 of the id as text, modulo ``parts``, is ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary content by language, from rows that are not held out."""
    rows = (docs.select("doc_id", "text", "lang")
            .where(~held_out() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
            .withColumn("h", F.xxhash64("doc_id", "lang", "text")))
    first = W.partitionBy("lang").orderBy("h")
    # the choice is made on hashes alone, equal rows count once; then SAMPLE_ROWS of them a language pick the texts
    chosen = (rows.select("lang", "h").distinct().withColumn("k", F.row_number().over(first))
              .where(F.col("k") <= SAMPLE_ROWS))
    most = F.ceil(F.lit(DICTIONARY) / F.count(F.lit(1)).over(W.partitionBy("lang")))
    chosen = chosen.select("lang", "h", F.greatest(F.lit(SAMPLE_MOST), most).cast("int").alias("share"))
    sample = shares(rows.join(F.broadcast(chosen), ["lang", "h"]).select("lang", "h", "share", "text"))
    sample = sample.groupBy("lang", "h").agg(F.min("text").alias("text"))
    content: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for r in sample.orderBy("lang", "h", "text").toLocalIterator():  # about SAMPLE_ROWS texts a language
        if size.get(r.lang, 0) < DICTIONARY:
            content.setdefault(r.lang, []).append(bytes(r.text))
            size[r.lang] = size.get(r.lang, 0) + len(content[r.lang][-1]) + 1
    # the end of a dictionary is reached with the smallest offsets, so the first rows go last
    return {lang: b"\n".join(texts[::-1])[-DICTIONARY:] for lang, texts in content.items()}


def shares(rows: DataFrame) -> DataFrame:
    """(lang, h, text): the first ``share`` bytes of each normal text, cut before they leave the task."""
    def run(batches):
        for batch in batches:
            texts = [normal(t.decode())[:k] for t, k in zip(texts_of(batch), batch.column("share").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(texts, pa.binary())],
                                             names=["lang", "h", "text"])

    return batched(rows, run, "lang string, h long, text binary")


def predict(text: bytes, languages: list[str], coders: list) -> tuple[str, float, bool]:
    sizes = [len(c.compress(text)) for c in coders]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    if len(sizes) == 1:
        return languages[0], 1.0, False
    second = min(s for k, s in enumerate(sizes) if k != best)
    margin = second - sizes[best]
    return languages[best], 1 / (1 + 2.0 ** -min(margin / HALVING, 60)), margin < NARROW * second


SCHEMA = "lang_pred string, score double, rejected boolean"


def identify(docs: DataFrame, keep: bool = False, dictionaries: dict[str, bytes] | None = None) -> DataFrame:
    """Language of every whole text; ``dictionaries`` default to those learned from ``docs``."""
    learned = learn(docs) if dictionaries is None else dictionaries
    languages = sorted(learned)
    shared = docs.sparkSession.sparkContext.broadcast([learned[k] for k in languages])

    def make():
        coders = []
        for content in shared.value:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            coders.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))

        def score(texts):
            out = []
            for raw in texts:
                text = raw.decode() if raw and coders else ""
                out.append(predict(normal(text), languages, coders) if _LETTER.search(text) else ("und", 0.0, True))
            langs, scores, rejected = zip(*out) if out else ((), (), ())
            return [pa.array(langs, pa.string()), pa.array(np.array(scores, float), pa.float64()),
                    pa.array(rejected, pa.bool_())]

        return score

    return per_document(docs, SCHEMA, make, keep)
