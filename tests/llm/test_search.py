"""Operator 13 against plain scoring of every document, and the treap against its cells."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import lexical_search
from ledgerlens.llm.common import plain_words


def brute(docs, items, k=10):
    rows = [(i, Counter(plain_words((x or "").encode()))) for i, x in docs]
    sizes = [sum(c.values()) for _, c in rows]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for _, c in rows for w in c)
    terms = {}
    for i, x in items:
        terms.setdefault(i, set()).update(plain_words((x or "").encode()))
    out = []
    for i, wanted in terms.items():
        scored = []
        for (d, c), size in zip(rows, sizes):
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (
                1_000_000_000 * c[w] // (1000 * c[w] + 8 * (10 + 90 * size * n // total))) for w in wanted if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = [f"{a}{b}" for a in ("lo", "Mi", "ra", "tu", "ne", "É") for b in ("k", "STER", "vo", "n9", "ß", "")]
    weight = [1 / (k + 1) for k in range(len(word))]
    prose = lambda n: " ".join(rng.choices(word, weight, k=n))
    docs = [(k, prose(rng.choice([1, 5, 40, 200]))) for k in range(200)]
    docs += [(300 + k, docs[7][1]) for k in range(60)]                       # copies: ties
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, prose(30)), (400, None), (401, ""), (402, "!? -"),
             (403, prose(30_000)), (404, "only-here_once")]
    items = [(k, prose(rng.choice([1, 3, 12, 60]))) for k in range(25)]
    items += [(50, None), (51, ""), (52, "unknownword"), (53, "here"), (1, prose(4)), (2, items[2][1]), (None, prose(5))]
    return docs, items


@pytest.mark.parametrize("block,cells,width", [(4096, 1 << 20, 200), (16, 1 << 20, 2), (4096, 60, 1)])
def test_search_equals_scoring_every_document(spark, make_docs, monkeypatch, block, cells, width):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical_search, "BLOCK_POSTINGS", cells)
    monkeypatch.setattr(lexical_search, "WIDTH", width)
    monkeypatch.setattr(lexical_search, "GROUP", 1 + width % 7)
    docs, items = corpus(block)
    table = spark.createDataFrame(items, "item_id long, text string")
    if width == 1:
        monkeypatch.setattr(lexical_search, "ITEM_BYTES", 500)               # several scans of the index
    wide = make_docs(docs).repartition(3).withColumn("SCORE", F.lit("x")).withColumn("rank", F.lit("y"))
    found = lexical_search.ranked_search(wide, table.withColumn("Doc_Id", F.lit("z")))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_search_of_empty_tables(spark, make_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.ranked_search(make_docs([]), items).count() == 0
    assert lexical_search.ranked_search(make_docs([(1, None), (2, " ")]), items).count() == 0
    assert lexical_search.ranked_search(make_docs([(1, "a")]), items.where("false")).count() == 0
    # a term that all documents have weighs nothing where its logarithm is below a thousandth
    assert lexical_search.ranked_search(make_docs([(k, "a c") for k in range(3000)]), items).count() == 0


def test_treap_keeps_its_cells_and_maxima():
    rng = np.random.default_rng(3)
    for height in (1, 3, 9):
        side = 1 << height
        cells = np.unique(rng.integers(0, side * side, 3 * side))
        rows, columns, values = cells // side, cells % side, rng.integers(1, 1 << 20, len(cells))
        built = lexical_search.Treap.build(rows, columns, values)
        back = lexical_search.Treap.unpacked(built.height, *built.packed())
        assert (back.maps == built.maps).all() and (back.best == built.best).all() and back.best[0] == values.max()
        found = {}

        def walk(node, level, row, column):
            if level == back.height:
                found[row, column] = int(back.best[node])
                return
            children = [q for q in range(4) if back.maps[node] >> q & 1]
            below = [back.child[node] + k for k in range(len(children))]
            assert max(back.best[c] for c in below) == back.best[node]
            for q, c in zip(children, below):
                walk(c, level + 1, 2 * row + (q >> 1), 2 * column + (q & 1))

        walk(0, 0, 0, 0)
        assert found == {(r, c): v for r, c, v in zip(rows.tolist(), columns.tolist(), values.tolist())}
