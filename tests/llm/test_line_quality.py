"""Operator 11: held-out accuracy on planted junk, marginals against enumeration, edge rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import line_quality, queries


def planted(n=400, seed=4):
    rng = random.Random(seed)
    word = [f"{a}{b}{c}" for a in "bcdfghjk" for b in ("a", "en", "or", "é") for c in ("ti", "so", "va", "ne", "x")]
    line = lambda: " ".join(rng.choices(word, k=rng.randint(4, 30))).capitalize() + "."
    junk = [lambda: line().upper().replace(" ", "!! "), lambda: line().replace(" ", " | "),
            lambda: " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in line().split()),
            lambda: " ".join(w for x in rng.choices(word, k=4) for w in [x] * 6)]
    rows, labels, bad = [], [], {}
    for k in range(n):
        lines = [line() for _ in range(rng.randint(1, 9))]
        if k % 4 == 0:
            make, first = rng.choice(junk), rng.randint(0, len(lines))
            more = [make() for _ in range(rng.randint(1, 5))]
            lines[first:first] = more
            bad[k] = list(range(first, first + len(more)))
        rows.append((k, "\n".join(lines)))
        labels.append((k, int(k % 4 != 0), k % 2))
    return rows, labels, bad


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_lines(spark, make_docs):
    rows, labels, bad = planted()
    found = line_quality.score_quality(make_docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(found) == len(rows) and len(held) > 100
    assert sum(r.predicted == (r.doc_id % 4 != 0) for r in held) >= 0.97 * len(held)
    right = sum(set(r.bad) == set(bad.get(r.doc_id, [])) for r in held)
    assert right >= 0.9 * len(held)
    assert all(r.n_lines == rows[r.doc_id][1].count("\n") + 1 and r.n_bad == len(r.bad) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)


def test_learns_nothing_from_held_out_rows_nor_from_other_columns(spark, make_docs):
    rows, labels, _ = planted(200)
    swapped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 3 == 1 else q, t) for k, q, t in labels]
    score = lambda docs, given: {r.doc_id: r.score for r in line_quality.score_quality(
        docs, spark.createDataFrame(given, LABELS)).collect()}
    docs = make_docs(rows)
    first = score(docs, labels)
    assert first == score(docs, swapped)
    assert first == score(docs.withColumn("lang", F.col("doc_id").cast("string")).withColumn("source", F.lit("z")), labels)


def test_marginals_equal_an_enumeration():
    rng = np.random.default_rng(2)
    emission, moves = rng.normal(size=(3, 6)), np.array([-0.7, 0.4, 1.1])
    size = [6, 3, 1]
    mask = np.arange(6) < np.array(size)[:, None]
    p, pairs = line_quality.forward_backward(emission, mask, moves)
    step = [[0.0, moves[0]], [moves[1], moves[2]]]
    for d, n in enumerate(size):
        weight = {t: np.exp(sum(emission[d, k] * t[k] for k in range(n)) + sum(step[a][b] for a, b in zip(t, t[1:])))
                  for t in itertools.product((0, 1), repeat=n)}
        total = sum(weight.values())
        assert np.allclose(p[d, :n], [sum(w for t, w in weight.items() if t[k]) / total for k in range(n)])
        assert not p[d, n:].any()
        for k in range(n - 1):
            for a, b in itertools.product((0, 1), repeat=2):
                assert np.isclose(pairs[d, k, a, b], sum(w for t, w in weight.items() if (t[k], t[k + 1]) == (a, b)) / total)


def test_documents_walked_together_or_alone_agree(monkeypatch):
    rng = np.random.default_rng(5)
    values = [rng.random((n, 3 * line_quality.OWN)) for n in (4, 0, 700, 1, 9, 30)]
    chain = line_quality.Chain(np.zeros(30), np.ones(30), rng.normal(size=34))
    together = chain.marginals(values)
    monkeypatch.setattr(line_quality, "PADDED", 1)
    assert all(np.allclose(a, b) for a, b in zip(together, chain.marginals(values)))


def test_neighbouring_lines_are_values(spark):
    values, sizes, at, n = line_quality.lines_of(b"Some words here.\n\nAA!! AA!!\r\n \t\nSome words here.")
    own = line_quality.OWN
    assert values.shape == (3, 3 * own) and sizes.tolist() == [16, 10, 16] and at.tolist() == [0, 2, 4] and n == 5
    assert (values[1:, own:2 * own] == values[:-1, :own]).all() and (values[:-1, 2 * own:] == values[1:, :own]).all()
    assert values[2, own - 1] == 1 and values[0, own - 1] == 0 and not values[0, own:2 * own].any()


def test_edge_rows(spark, make_docs):
    rows, labels, _ = planted(120)
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (None, rows[0][1]), (0, rows[0][1]), (0, rows[0][1]),
             (1003, "\n".join(["Good words of a line."] * 3000)), (1004, "x" * 200_000), (1005, "é\u0000 \r")]
    labels += [(0, 1, 0), (0, None, 0), (None, 0, 0), (77777, 0, 0)]
    docs = make_docs(rows)
    given = spark.createDataFrame(labels, LABELS)
    wide = docs.withColumn("Score", F.lit("mine")).withColumn("n_bad", F.lit("too"))
    found = line_quality.score_quality(wide, given, keep=True)
    assert "Score" not in found.columns and found.columns[:2] == ["doc_id", "text"]
    got = found.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1000].score == by[1001].score == by[1002].score >= 0.5 and by[1000].n_lines == 0 and by[1002].n_lines == 3
    assert by[1002].n_bad == 0
    assert by[None].score == by[0].score and by[1003].n_lines == 3000


@pytest.mark.parametrize("labels", [[], [(k, 1, 0) for k in range(50)], [(9000 + k, k % 2, 0) for k in range(2000)]])
def test_without_both_labels_everything_is_kept(spark, make_docs, labels):
    docs = make_docs(planted(30)[0] + [(500, None)])
    found = line_quality.score_quality(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == 31 and {(r.score, r.predicted) for r in found} == {(1.0, 1)}
    assert line_quality.score_quality(make_docs([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_query_marks_the_held_out_rows(spark, sf_small):
    found = queries.op11_line_quality(spark, sf_small).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
