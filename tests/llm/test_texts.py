"""Operators that look at one text at a time: 1 (licences), 3 (BPE), 6 (decontamination),
8 (toxicity), 10 (language)."""

import hashlib
import random
import re
import time
import zlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, decontaminate, language_id, license_scan, toxicity

EDGE = [(1, None), (2, ""), (3, " \n\t "), (None, "all rights reserved cc by"), (4, "a b"), (4, "a b"), (4, "c"),
        (5, "word " * 30_000), (6, "x" * 100_000), (7, "Ünï ß 東京 cc-BY"), (8, "\x00\x1c a")]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# -- 1 -------------------------------------------------------------------------------------

def brute_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = sorted((i, p) for p in license_scan.BASE_PHRASES for i in range(len(words))
                if words[i:i + len(p.split())] == p.split())
    return (len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None,
            ",".join(sorted({license_scan.BASE_PHRASES[p] for _, p in at})))


def test_license_base_matches_brute_force(make_docs):
    rng = random.Random(3)
    bits = ["CC", "by", "-", " ", "BY", "\n", "general", "public", "license", ", ", "All", "rights", "reserved", "."]
    rows = EDGE + [(100 + k, "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 40))))
                   for k in range(200)]
    got = license_scan.license_scan(make_docs(rows)).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:6]))
    want = sorted(((i, *brute_phrases(x)) for i, x in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)


@pytest.mark.parametrize("text,order", [
    ("MIT OR Apache-2.0 AND ISC", "mit apache-2.0 isc and or"),
    ("(MIT OR Apache-2.0) AND ISC", "mit apache-2.0 or isc and"),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", "gpl-2.0 classpath-exception-2.0 with mit or"),
    ("MIT AND (ISC OR (0BSD))", "mit isc 0bsd or and"), ("a OR b OR c AND d", "a b or c d and or"),
    ("MIT OR", "mit"), ("(MIT", None), ("MIT)", "mit"), ("MIT ISC", "mit"), ("", None), ("AND", None), ("()", None)])
def test_shunting_yard(text, order):
    found = license_scan.leading(text.encode(), 0)
    assert (None if found is None else " ".join(found)) == order


def test_license_positions_in_a_long_text():
    """Positions are counted on, not from the start for every hit."""
    words = ["all", "rights", "reserved", "x", "cc", "by"] * 20_000
    began = time.process_time()
    found = license_scan.scan_text(" ".join(words).encode())
    assert time.process_time() - began < 5
    assert found[:4] == (120_000, 40_000, 0, 119_998)


def test_license_expression_choice():
    either = license_scan.scan_text(b"// SPDX-License-Identifier: GPL-2.0 OR MIT\nx")
    both = license_scan.scan_text(b"/* SPDX-License-Identifier: (GPL-2.0 AND MIT) */")
    assert either[8] == 0.95 and both[8] == 0.3
    assert either[5] == both[5] == "gpl,mit"


@pytest.mark.parametrize("text,order", [
    ("MIT Copyright 2020 The Authors", "mit"), ("MIT. All of it", "mit"), ("MIT, see LICENSE", "mit"),
    ("Apache-2.0 OR MIT */ int main()", "apache-2.0 mit or"), ("<!-- x", None), ("MIT--> <p>", "mit"),
    ("(GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause Copyright (c) 2020",
     "gpl-2.0-only classpath-exception-2.0 with bsd-3-clause and"),
    ("MIT OR", "mit"), ("MIT) and more", "mit"), ("(MIT OR ISC", None), ("MIT and see the file below", "mit"),
    ("mit or apache-2.0 this file is", "mit apache-2.0 or"), ("foo-1 or bar-2", "foo-1 bar-2 or"),
    ("MIT SPDX-License-Identifier: ISC", "mit"), ('"MIT OR ISC", "name": "x"', "mit isc or"),
    (" AND ".join(["LicenseRef-" + "x" * 90] * 40), " ".join(["licenseref-" + "x" * 90] + ["licenseref-" + "x" * 90 + " and"] * 39))])
def test_license_tag_in_running_text(text, order):
    found = license_scan.scan_text(b"word SPDX-License-Identifier: " + text.encode())
    assert found[7] == order and (found[8] is None) == (order is None)


def test_license_tags_of_one_line_all_count():
    found = license_scan.scan_text(b"a SPDX-License-Identifier: MIT b SPDX-License-Identifier: GPL-2.0 Copyright")
    assert found[5] == "gpl,mit" and found[7] == "mit" and found[8] == 0.3


# -- 3 -------------------------------------------------------------------------------------

def test_perfect_hash_is_minimal_and_exact():
    ranks = bpe.read_ranks(RANKS)
    table = bpe.PerfectHash(list(ranks))
    assert sorted(table.index_at) == list(range(len(ranks)))
    assert all(table.find(k) == i for i, k in enumerate(ranks))
    assert table.find(b"no such entry at all") == -1


def test_bpe_equals_the_tokenizer_library(make_docs):
    rng = random.Random(1)
    bits = ["a", "b ", " ", "\n", "\t", "'s", "\x1c", "é", "1", ".", "　", "\r", "\x85", "  ", "東", "the", " of"]
    rows = EDGE + [(100 + k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(800)]
    got = bpe.encode_documents(make_docs(rows), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                                special_tokens={})
    want = []
    for i, x in rows:
        ids = library.encode_ordinary(x or "")
        want.append((str(i), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((x or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert all(len(r.token_ids) == r.n_tokens for r in got)


# -- 6 -------------------------------------------------------------------------------------

def brute_hits(rows, items, window=13, share=20):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    windows = set()
    for i, x in items:
        w = words(x)
        n = min(window, len(w))
        windows |= {(n, tuple(w[s:s + n]), i) for s in range(len(w) - n + 1) if n}
    out = []
    for d, x in rows:
        w, hit, found = words(x), set(), set()
        for n, piece, i in windows:
            for s in range(len(w) - n + 1):
                if w[s] == piece[0] and tuple(w[s:s + n]) == piece:
                    hit |= set(range(s, s + n))
                    found |= set() if i is None else {str(i)}
        out.append((str(d), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and share * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_decontamination_matches_brute_force(spark, make_docs, monkeypatch, block):
    """One block of the benchmark, and many (the path beyond the broadcast bound)."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(5)
    word = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(word, k=rng.randint(14, 30)))) for k in range(20)]
    items += [(20, "Short Item here"), (21, None), (22, ""), (None, "null item " + " ".join(word[:13])), (0, items[0][1])]
    rows = [r for r in EDGE if not r[1] or len(r[1]) < 1000]
    for k in range(60):
        text = " ".join(rng.choices(word, k=rng.randint(0, 200)))
        if k % 3 == 0:
            text += ", " + items[k % 20][1].upper() + "! " + " ".join(rng.choices(word, k=k))
        rows.append((100 + k, text + (" short item-here" if k % 7 == 0 else "")))
    rows.append((300, "null item " + " ".join(word[:13])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(make_docs(rows), bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == brute_hits(rows, items)
    kept = decontaminate.find_contamination(make_docs(rows), bench, keep=True)
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == len(rows)


def test_decontamination_with_an_empty_benchmark(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontaminate.find_contamination(make_docs(EDGE), bench).collect()} == {False}


# -- 8 -------------------------------------------------------------------------------------

def toxic_rows():
    rng = random.Random(2)
    plain = [f"{a}{b}" for a in "bcdfg" for b in ("ola", "ari", "endo", "umin", "esto", "ipol")]
    rows, labels = [], []
    for k in range(600):
        words = rng.choices(plain, k=rng.randint(5, 60))
        if k % 4 == 0:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["vilegrub", "rottenfool", "Sludgehead"]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(k % 4 == 0)))
    return rows, labels


def test_toxicity_held_out_accuracy_and_spans(spark, make_docs):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (9_999, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(make_docs(rows), marks).collect()}
    held = [k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0]
    right = sum(got[k].predicted == int(k % 4 == 0) for k in held)
    assert len(held) > 80 and right / len(held) > 0.97
    words = [rows[k][1][s.first:s.until].lower() for k in held for s in got[k].offending]
    real = sum(w in ("vilegrub", "rottenfool", "sludgehead") for w in words)
    assert real / len(words) > 0.9
    assert real == sum(rows[k][1].lower().count(w) for k in held for w in ("vilegrub", "rottenfool", "sludgehead"))


def test_toxicity_edge_rows(spark, make_docs):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(make_docs(rows), marks)
    got = toxicity.score_toxicity(make_docs(EDGE), marks, model=model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    none = toxicity.score_toxicity(make_docs(rows), marks.where("toxic = 0")).collect()  # nothing to learn
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_toxicity(make_docs([]), marks).count() == 0


def test_toxicity_lexicon_keeps_every_significant_word(spark):
    """6,000 toxic words with 30,000 entries of their own: none is lost, and stems stand for theirs."""
    rng = random.Random(6)
    words = [f"{k:05d}abcdef" for k in range(6_000)]
    rows = [(" ".join(rng.sample(words, 3_000)), 1) for _ in range(160)] + [(f"plain text {k}", 0) for k in range(600)]
    found = toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int").repartition(8))
    odds = toxicity.Odds(found)
    assert all(odds[w.encode()] > 1.5 for w in words)
    assert len(found) < 7_000
    assert toxicity.covering(b"abcdefg") == [b"abcde*", b"abcdef*", b"abcdefg*"]
    assert toxicity.covering(b"abcdef*") == [b"abcde*"] and toxicity.covering(b"abc") == []


def test_toxicity_of_a_lexicon_too_large_to_broadcast(spark, make_docs, monkeypatch):
    from ledgerlens.llm import sketch
    monkeypatch.setattr(sketch, "WIDTH", 1 << 18)
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make_docs(rows + [r for r in EDGE if not r[1] or len(r[1]) < 1000] + [rows[0], rows[0]])
    result = lambda: sorted((str(r.doc_id), r.text or "", round(r.score, 9), r.predicted, str(r.offending)) for r in
                            toxicity.score_toxicity(docs, marks, keep=True).collect())
    want = result()
    monkeypatch.setattr(toxicity, "LEXICON_BYTES", 0)
    assert result() == want and any(x[3] for x in want)
    assert toxicity.score_toxicity(docs, marks, keep=True).columns == docs.columns + ["score", "predicted", "n_offending", "offending"]


def test_marginals_equal_a_plain_forward_backward():
    """The closed form over runs of plain words gives what the step by step chain gives."""
    import numpy as np
    chain = toxicity.Chain([-4.0, 0.4, 0.7, -1.5, -1.2, 0.3])
    rng = np.random.default_rng(4)
    texts = [rng.random(n) * (rng.random(n) < 0.2) * 5 for n in (1, 7, 60, 200, 3)]
    at = [np.flatnonzero(x) for x in texts]
    p, mask = chain.marginals([x[a] for x, a in zip(texts, at)], at, np.array([len(x) for x in texts]))
    for k, x in enumerate(texts):
        emit = np.stack([np.ones(len(x)), np.where(x > 0, chain.emission(x), np.exp(chain.weights[0]))], 1)
        alpha, beta = [np.ones(2) / 2 @ chain.step * emit[0]], [np.ones(2)]
        for e in emit[1:]:
            alpha.append(alpha[-1] @ chain.step * e)
        for e in emit[:0:-1]:
            beta.append(chain.step @ (e * beta[-1]))
        joint = np.array(alpha) * np.array(beta[::-1])
        assert np.allclose(p[k][mask[k]], (joint[:, 1] / joint.sum(1))[at[k]])


# -- 10 ------------------------------------------------------------------------------------

def language_rows():
    rng = random.Random(8)
    sound = {"aa": ["tion", "the", "ing", "er"], "bb": ["ção", "que", "inho", "ár"], "cc": ["ung", "sch", "keit", "ü"]}
    rows = []
    for k in range(400):
        lang = ("aa", "bb", "cc")[k % 3]
        words = ["".join(rng.choices(sound[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(12, 60))]
        rows.append((k, " ".join(words), lang))
    return rows


def test_language_held_out_accuracy(make_docs):
    rows = language_rows()
    got = {r.doc_id: r for r in language_id.identify(make_docs(rows)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 60 and sum(got[i].lang_pred == lang for i, _, lang in held) / len(held) > 0.97


def test_language_learns_nothing_from_held_out_rows(make_docs):
    docs = make_docs(language_rows())
    changed = docs.withColumn("lang", F.when(language_id.held_out(), "zz").otherwise(F.col("lang")))
    assert language_id.learn(docs) == language_id.learn(changed)


def test_language_of_long_texts_only_is_learned(make_docs):
    """Every text of dd is above 20,000 bytes; one of ee's two starts with as many bytes of digits."""
    rng = random.Random(21)
    prose = lambda sound, n: " ".join("".join(rng.choices(sound, k=2)) for _ in range(n))
    dd, ee = ["wyr", "cze", "dzi", "osc"], ["aikka", "yyt", "uom", "inen"]
    rows = language_rows() + [(5000 + k, prose(dd, 4_000), "dd") for k in range(12)]
    rows += [(6000 + k, "12 " * 9_000 + prose(ee, 6_000), "ee") for k in range(9)]
    rows += [(7000 + k, prose((dd, ee)[k % 2], 40), None) for k in range(20)]
    learned = language_id.learn(make_docs(rows))
    assert sorted(learned) == ["aa", "bb", "cc", "dd", "ee"]
    assert len(learned["dd"]) == len(learned["ee"]) == language_id.DICTIONARY
    got = {r.doc_id: r.lang_pred for r in language_id.identify(make_docs(rows), dictionaries=learned).collect()}
    assert all(got[7000 + k] == ("dd", "ee")[k % 2] for k in range(20))
    one = language_id.learn(make_docs([(0, rows[400][1] * 2, "dd")]))  # a single row may fill more
    assert len(one["dd"]) > 2 * language_id.SAMPLE_MOST


def test_language_edge_rows(make_docs):
    rows = language_rows() + [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ... !", "aa"), (None, "the tion", None),
                              (1003, "tion the " * 40_000, None), (1003, "x", None)]
    got = [r for r in language_id.identify(make_docs(rows)).collect() if r.doc_id is None or r.doc_id >= 1000]
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001, 1002)} == {
        k: ("und", 0.0) for k in (1000, 1001, 1002)}
    assert all(r.lang_pred in ("aa", "bb", "cc") for r in got if r.doc_id is None or r.doc_id == 1003)
    unlabelled = make_docs([(1, "abc", None), (2, None, None)])
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(make_docs([])).count() == 0


def test_clashing_columns_give_way(make_docs):
    docs = make_docs([(1, "cc by"), (2, None)]).withColumns({
        "score": F.lit("mine"), "labels": F.lit(1), "n_tokens": F.lit("x"), "hits": F.lit(0), "row": F.lit(3)})
    got = license_scan.license_scan(docs, keep=True)
    assert dict(got.dtypes)["score"] == "double" and got.where("labels = 'cc-by'").count() == 1
    assert bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, keep=True).agg(F.sum("n_tokens")).first()[0] == 2
