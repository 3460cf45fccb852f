"""The corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes all that its predecessor kept and its decisions take effect. ``run`` writes each
stage's result to the shared folder as Parquet and reads it back for the next.

1. toxicity: documents predicted toxic go.
2. near_duplicates: of each component of texts linked by a Jaccard similarity of 0.8 or more over
   five-word shingles, the document of smallest doc_id stays.
3. passages: words inside a 50-word passage that a document of smaller doc_id has go; a document
   of which nothing is left goes, unchanged texts keep their layout.
4. decontamination: documents of which a twentieth or more lies in benchmark windows go.
5. tokens: byte-level BPE ids of every text.

The first and last stage have no SQL twin (a trained chain, a tokenizer), so ORACLE_SQL is None
and tests hold the stages against brute force."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import encode_documents
from ledgerlens.llm.common import read_documents, scratch, written
from ledgerlens.llm.decontaminate import find_contamination
from ledgerlens.llm.jaccard_join import one_of_each
from ledgerlens.llm.substring_dedup import dedup_passages
from ledgerlens.llm.toxicity import score_toxicity

ORACLE_SQL = None


#: Column that carries a row's other columns through an operator, out of reach of its own columns.
ROW = "carried_row"


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one struct."""
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("doc_id", "text")]
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"),
                       F.struct(F.lit(None).cast("int").alias("carried_nothing"), *others).alias(ROW))


def _restored(found: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` as they were, doc_id and text as the operator left them; ``changed``
    names columns (in small letters) with a function of the old value."""
    out = []
    for c in docs.columns:
        name = c.lower()
        value = F.col(name if name in ("doc_id", "text") else f"{ROW}.`{c}`")
        out.append((changed[name](value) if name in changed else value).alias(c))
    return found.select(*out)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = score_toxicity(_carried(docs), read_documents(spark, sf_dir, "labels"), keep=True)
    return _restored(scored.where("predicted = 0"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = dedup_passages(_carried(docs), keep=True).where("n_removed = 0 or n_removed < n_words")
    kind = {f.name.lower(): f.dataType for f in docs.schema.fields}.get("n_chars", "long")
    return _restored(found, docs, n_chars=lambda old: F.when(
        F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(old))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanned = find_contamination(_carried(docs), read_documents(spark, sf_dir, "benchmark"), keep=True)
    return _restored(scanned.where("not contaminated"), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                            with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        with scratch():  # a stage's working tables go when its result is written
            docs = written(stage(spark, docs, sf_dir), name, stays=True)
    return STAGES[-1][1](spark, docs, sf_dir)
