"""The pipeline on planted rows: toxic texts, copies, repeated passages, benchmark passages."""

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import bpe, decontaminate, sketch, toxicity


@pytest.fixture()
def planted(spark, make_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(sketch, "WIDTH", 1 << 18)
    rng = random.Random(12)
    word = [f"{a}{b}{c}" for a in "bcdfghjk" for b in ("a", "en", "or", "ul") for c in ("ti", "so", "va", "ne", "x")]
    prose = lambda n: " ".join(rng.choices(word, k=n))
    passage, item = prose(60), prose(20)
    rows = {k: prose(rng.randint(60, 160)) for k in range(300)}
    labels = []
    for k in range(0, 300, 4):
        w = rows[k].split()
        for _ in range(3):
            w.insert(rng.randrange(len(w)), rng.choice(["vilegrub", "rottenfool", "sludgehead"]))
        rows[k] = " ".join(w)
    labels = [(k, 1, int(k % 4 == 0)) for k in range(200)]
    clean = [k for k in rows if k % 4]
    rows[1000] = rows[clean[0]]                                   # an exact copy
    w = rows[clean[1]].split()
    w[10] = "changed"
    rows[1001] = " ".join(w) if len(w) > 110 else rows[clean[1]] + " end"   # a near copy
    rows[clean[2]] = prose(40) + " " + passage + "\n" + prose(40)
    rows[1002] = prose(50) + " " + passage + " " + prose(50)      # a repeated passage
    rows[1003] = prose(30) + " " + item + " " + prose(30)         # contaminated
    rows[1004], rows[1005] = None, ""
    folder = str(tmp_path)
    make_docs(sorted(rows.items())).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, clean, passage


def test_stages_and_result(spark, planted):
    folder, rows, clean, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        assert docs.columns == columns
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert ids["toxicity"] == {k for k in rows if k >= 1000 or k % 4}
    assert ids["toxicity"] - ids["near_duplicates"] == {1000, 1001}
    assert ids["passages"] == ids["near_duplicates"]
    assert ids["passages"] - ids["decontamination"] == {1003}
    left = {r.doc_id: r for r in docs.collect()}
    assert passage not in left[1002].text and passage in left[clean[2]].text
    assert left[1002].n_chars == len(left[1002].text)
    assert {k: r.text for k, r in left.items() if k != 1002} == {k: rows[k] for k in left if k != 1002}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")))
    found = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id: list(r.token_ids) for r in found} == {k: library.encode_ordinary(r.text or "") for k, r in left.items()}


CLASHES = ["Score", "predicted", "n_offending", "N_WORDS", "n_removed", "kept_sha256", "hits", "Found_Starts", "found_items",
           "_row_key", "_key", "_listed", "row", "spans", "changed", "n_hit", "contaminated", "carried_row", "H", "toxic"]


def test_user_columns_stay_as_they_are(spark, planted, monkeypatch):
    folder, *_ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rich = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    spark.createDataFrame([(k, "word%d other%d" % (k, k) * 40) for k in range(30)], "item_id long, text string").union(
        spark.read.parquet(f"{folder}/benchmark.parquet")).write.mode("append").parquet(f"{folder}/more/benchmark.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{folder}/more/labels.parquet")
    for block, joined, where in ((1 << 20, toxicity.LEXICON_BYTES, folder), (1000, 0, f"{folder}/more")):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        monkeypatch.setattr(toxicity, "LEXICON_BYTES", joined)  # many blocks and a joined lexicon, too
        stages = corpus_pipeline.STAGES[:-1]
        for name, stage in stages if joined else [stages[0], stages[3]]:
            plain = {r.doc_id: r.text for r in stage(spark, docs, where).collect()}
            found = stage(spark, rich, where)
            assert found.columns == rich.columns and found.dtypes == rich.dtypes
            rows = found.collect()
            assert {r.doc_id: r.text for r in rows} == plain, name
            assert all(r[c] == f"{c}:{r.doc_id}" for r in rows for c in CLASHES)
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, rich, folder).collect()} == {
        r.doc_id for r in docs.collect()}


def test_labels_of_absent_documents_reject_nothing(spark, planted):
    folder, rows, *_ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    orphans = spark.createDataFrame([(5000 + k, 1, k % 2) for k in range(3000)], "doc_id long, quality int, toxic int")
    found = toxicity.score_toxicity(docs, orphans).collect()
    assert {(r.score, r.predicted) for r in found} == {(0.0, 0)} and len(found) == len(rows)
    half = orphans.union(spark.read.parquet(f"{folder}/labels.parquet"))
    caught = {r.doc_id for r in toxicity.score_toxicity(docs, half).collect() if r.predicted}
    assert caught == {k for k in rows if k < 1000 and k % 4 == 0}


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_empty_tables(spark, planted, empty, tmp_path):
    folder, rows, *_ = planted
    other = str(tmp_path / "other")
    for table in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{folder}/{table}.parquet")
        df.where(F.lit(table != empty)).write.parquet(f"{other}/{table}.parquet")
    found = {r.doc_id for r in corpus_pipeline.run(spark, other).collect()}
    if empty == "documents":
        assert not found
    else:
        assert {0, 4, 1004, 1005} <= found and not {1000, 1001, 1003} & found


def test_repeated_rows_and_a_very_long_text(spark, planted, make_docs):
    folder, rows, clean, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    long_text = " ".join(f"w{k % 997}x{k % 1013}" for k in range(60_000))
    docs = docs.union(docs).union(make_docs([(2000, long_text), (None, long_text + " end"), (None, None)]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
    found = [r.doc_id for r in docs.collect()]
    assert found.count(clean[5]) == 1 and found.count(1004) == 2 and found.count(2000) == 1 and found.count(None) == 1
