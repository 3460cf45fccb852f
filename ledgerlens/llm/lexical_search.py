"""Operator 13: ranked lexical search by K2-treaps over the term-document grid.

Index: documents are cut into blocks (of ``BLOCK_DOCS`` documents or ``BLOCK_POSTINGS`` cells at
most, but one document at least), wherever they lie. A block's grid has a row for every term, most
frequent first, a column for every document, shortest first, and as the value of a cell the impact
of the term in the document. The grid is kept as a K2-treap: a quadtree whose cells store the
maximum impact below them, written level by level as four-bit child maps and as differences from
the parent's maximum. The blocks are a table, so they are built once and searched by many tasks.

Search: an item follows the path of each of its terms' rows down the tree at once. A range of
documents carries the cells its terms have reached; the sum of their weighted maxima bounds the
score of every document in the range. The ranges with the best bounds are opened first, those
below the item's present k-th score never. A task keeps its k best documents of each item over all
blocks it reads, so later blocks are cut by the scores of earlier ones, and hands on these alone.

Score: the sum over the item's distinct terms of w * ((1000000000 * tf) div (1000 * tf + 8 * m)) in
64-bit integers, w = floor(1000 * ln((2N + 2) / (2 df + 1))), m = 10 + (90 * n * N) div L.

Defined results: null and empty texts have no terms, count nowhere and are never found; every row
is a document of its own, so repeated rows are all found, ties going to the smaller doc_id and null
last; the rows of one item_id are one item (also those of a null one); an item without known terms
has no rows; empty tables give no rows; other columns are ignored. doc_id is an integer column."""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, plain_words, texts_of, written

#: Documents and cells of a block.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
#: Benchmark text (bytes) searched for in one scan of the index.
ITEM_BYTES = 2 << 20
#: Items whose ranges are opened together, and ranges opened for each of them in a step.
GROUP, WIDTH = 64, 200

_POPCOUNT = np.array([bin(k).count("1") for k in range(16)], np.uint8)
#: Children of a child map that stand before child q: _BEFORE[map, q].
_BEFORE = np.array([[bin(k & ((1 << q) - 1)).count("1") for q in range(4)] for k in range(16)], np.int64)


# -- the treap -----------------------------------------------------------------------------

def spaced(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers, each followed by a zero bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """``maps``: child maps of the inner nodes, level by level from the root; ``best``: the maximum
    below every node and, at the last level, the cells' values; ``child``: a node's first child."""

    def __init__(self, height: int, maps: np.ndarray, best: np.ndarray):
        self.height, self.maps, self.best = height, maps, best
        self.child = 1 + np.cumsum(_POPCOUNT[maps], dtype=np.int64) - _POPCOUNT[maps]

    @classmethod
    def build(cls, rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
        """Cells (row, column, value above 0), each once, at least one."""
        height = max(1, int(max(rows.max(), columns.max())).bit_length())
        code = spaced(rows) << np.uint64(1) | spaced(columns)
        order = np.argsort(code)
        code, value = code[order], values[order].astype(np.int64)
        levels, maps = [value], []
        for _ in range(height):
            above = code >> np.uint64(2)
            first = np.concatenate(([0], np.flatnonzero(above[1:] != above[:-1]) + 1))
            bit = np.left_shift(np.uint8(1), (code & np.uint64(3)).astype(np.uint8))
            maps.append(np.bitwise_or.reduceat(bit, first))
            value = np.maximum.reduceat(value, first)
            levels.append(value)
            code = above[first]
        return cls(height, np.concatenate(maps[::-1]), np.concatenate(levels[::-1]))

    def packed(self) -> tuple[bytes, bytes]:
        """Child maps, and each node's maximum as the difference from its parent's, compressed."""
        parent = np.repeat(np.arange(len(self.maps)), _POPCOUNT[self.maps])
        less = np.concatenate((self.best[:1], self.best[parent] - self.best[1:])).astype(np.uint32)
        coder = zstandard.ZstdCompressor(level=3)
        return coder.compress(self.maps.tobytes()), coder.compress(less.tobytes())

    @classmethod
    def unpacked(cls, height: int, maps: bytes, less: bytes) -> Treap:
        coder = zstandard.ZstdDecompressor()
        maps, less = np.frombuffer(coder.decompress(maps), np.uint8), np.frombuffer(coder.decompress(less), np.uint32)
        out = cls(height, maps, np.empty(len(less), np.int64))
        out.best[0] = less[0]
        lo, hi = 0, 1
        for _ in range(height):  # children of the nodes lo:hi lie behind each other
            parent = np.repeat(np.arange(lo, hi), _POPCOUNT[maps[lo:hi]])
            lo, hi = hi, hi + len(parent)
            out.best[lo:hi] = out.best[parent] - less[lo:hi]
        return out


# -- building ------------------------------------------------------------------------------

def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, all their terms."""
    def run(batches):
        for batch in batches:
            sizes = [len(plain_words(t)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(s > 0 for s in sizes)], pa.int64()), pa.array(
                [sum(sizes)], pa.int64())], names=["n", "l"])

    r = batched(docs.select("text"), run, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return r.n or 0, r.l or 0


INDEX = ("doc_ids array<long>, n_terms int, n_cells long, height int, terms binary, found_in binary, "
         "maps binary, maxima binary")


class Block:
    """Gathers documents and writes them as one row of the index."""

    def __init__(self, n: int, total: int):
        self.n, self.total = n, total
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.terms: dict[bytes, int] = defaultdict(count().__next__)  # numbers the terms as they come
        self.rows: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.cells = 0

    def add(self, doc_id, words: list[bytes]) -> None:
        counts = Counter(words)
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.rows.append(np.fromiter(map(self.terms.__getitem__, counts), np.int64, len(counts)))
        self.tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.cells += len(counts)

    def record(self) -> pa.RecordBatch:
        sizes = np.array(self.sizes, np.int64)
        by_size = np.argsort(sizes, kind="stable")
        place = np.empty(len(sizes), np.int64)
        place[by_size] = np.arange(len(sizes))
        each = [len(r) for r in self.rows]
        rows, tf = np.concatenate(self.rows), np.concatenate(self.tf)
        m = np.array([10 + 90 * s * self.n // self.total for s in self.sizes], np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, each))
        found_in = np.bincount(rows, minlength=len(self.terms))
        by_frequency = np.argsort(-found_in, kind="stable")
        row_of = np.empty(len(by_frequency), np.int64)
        row_of[by_frequency] = np.arange(len(by_frequency))
        some = impact > 0  # an impact of 0 adds nothing to any score
        if not some.any():
            some, impact = some | True, np.maximum(impact, 0)
        treap = Treap.build(row_of[rows][some], np.repeat(place, each)[some], impact[some])
        maps, maxima = treap.packed()
        terms = list(self.terms)
        coder = zstandard.ZstdCompressor(level=3)
        values = [[self.ids[k] for k in by_size.tolist()], len(terms), len(rows), treap.height,
                  coder.compress(b" ".join([terms[k] for k in by_frequency.tolist()])),
                  coder.compress(found_in[by_frequency].astype(np.uint32).tobytes()), maps, maxima]
        kinds = [pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                          names=[f.split()[0] for f in INDEX.split(", ")])


def build_index(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(index, N, L): one row for each block, every document with a term in one of them."""
    n, total = corpus_size(docs)

    def run(batches):
        block = Block(n, total)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                words = plain_words(text)
                if not words:
                    continue
                block.add(doc_id, words)
                if len(block.ids) >= BLOCK_DOCS or block.cells >= BLOCK_POSTINGS:
                    yield block.record()
                    block = Block(n, total)
        if block.ids:
            yield block.record()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(batched(rows, run, INDEX), "treaps"), n, total


# -- searching -----------------------------------------------------------------------------

def search_block(treap: Treap, doc_ids: list, rows: list[np.ndarray], weights: list[np.ndarray], k: int,
                 best: list[list]) -> None:
    """Best-first search of one block for several items: ``rows`` and ``weights`` of each item's
    terms; ``best`` holds each item's k best (score, doc_id) so far, best first, and is changed.

    Ranges are kept in flat arrays: item, level, first column, bound, and their cells (term, node)
    from ``begin`` to ``until``. A step opens the best ranges of every item at once."""
    floor = np.array([b[k - 1][0] if len(b) >= k else 1 for b in best], np.int64)
    size = [len(r) for r in rows]
    term_row, term_weight = np.concatenate(rows), np.concatenate(weights)
    ends = np.cumsum(size)
    item = np.flatnonzero(size).astype(np.int64)
    level, column = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    begin, until = (ends - size)[item], ends[item]
    total = np.array([int(w.sum()) for w in weights], np.int64)
    bound = total[item] * int(treap.best[0])
    cell_term, cell_node = np.arange(len(term_row)), np.zeros(len(term_row), np.int64)
    n_columns = len(doc_ids)
    while True:
        alive = bound >= floor[item]
        if not alive.all():
            item, level, column, begin, until, bound = (x[alive] for x in (item, level, column, begin, until, bound))
        if not len(item):
            return
        order = np.lexsort((-bound, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        opened = order[rank < WIDTH]
        held = np.ones(len(item), bool)
        held[opened] = False
        o_item, o_level, o_column, o_begin, o_until = (x[opened] for x in (item, level, column, begin, until))
        counts = o_until - o_begin
        of = np.repeat(np.arange(len(opened)), counts)
        at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + o_begin[of]
        term, node = cell_term[at], cell_node[at]
        deep = treap.height - 1 - o_level[of]
        lower = term_row[term] >> deep & 1
        maps = treap.maps[node]
        news = []
        for right in (0, 1):
            q = 2 * lower + right
            has = (maps >> q.astype(np.uint8) & 1).astype(bool)
            child = treap.child[node[has]] + _BEFORE[maps[has], q[has]]
            news.append((2 * of[has] + right, term[has], child))
        to, term, node = (np.concatenate(x) for x in zip(*news))
        order = np.argsort(to, kind="stable")
        to, term, node = to[order], term[order], node[order]
        new = np.unique(to)
        first = np.searchsorted(to, new)
        last = np.append(first[1:], len(to))
        score = np.add.reduceat(term_weight[term] * treap.best[node], first) if len(to) else np.zeros(0, np.int64)
        n_item, n_level = o_item[new >> 1], o_level[new >> 1] + 1
        n_column = 2 * o_column[new >> 1] + (new & 1)
        good = score >= floor[n_item]
        leaf = good & (n_level == treap.height)
        touched = np.unique(n_item[leaf])
        for i in touched.tolist():
            mine = np.flatnonzero(leaf & (n_item == i))
            found = [(s, doc_ids[c]) for s, c in zip(score[mine].tolist(), n_column[mine].tolist()) if c < n_columns]
            best[i] = heapq.nsmallest(k, best[i] + found, key=ranked)
            if len(best[i]) == k:
                floor[i] = best[i][-1][0]
        inner = np.flatnonzero(good & (n_level < treap.height))
        # the cells of the ranges that stay and of the new ones, packed anew
        stay = np.flatnonzero(held)
        counts = until[stay] - begin[stay]
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(begin[stay], counts)
        more = last[inner] - first[inner]
        also = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + np.repeat(first[inner], more)
        cell_term, cell_node = np.concatenate((cell_term[at], term[also])), np.concatenate((cell_node[at], node[also]))
        counts = np.concatenate((counts, more))
        until = np.cumsum(counts)
        begin = until - counts
        item, level, column, bound = (np.concatenate((old[stay], made[inner])) for old, made in (
            (item, n_item), (level, n_level), (column, n_column), (bound, score)))


def ranked(found: tuple) -> tuple:
    """Sort key of (score, doc_id): best first, ties by doc_id, null last."""
    return -found[0], found[1] is None, found[1] or 0


def _terms(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b" ")


def document_counts(index: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """df of the words that occur, summed over the blocks of the index."""
    shared = index.sparkSession.sparkContext.broadcast(words)  # of at most ITEM_BYTES of items

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("found_in").to_pylist()):
                counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.uint32)
                for k, w in enumerate(_terms(terms)):
                    if w in shared.value:
                        found[w] += int(counts[k])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                         names=["term", "df"])

    rows = batched(index.select("terms", "found_in"), run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r.term): r.df for r in rows.toLocalIterator()}


def item_blocks(items: DataFrame):
    """[(item_id, its terms)], of about ``ITEM_BYTES`` of text at a time."""
    rows = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(size) // ITEM_BYTES
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b)
        found: dict = {}
        for r in part.toLocalIterator():
            found.setdefault(r.item_id, set()).update(plain_words(None if r.text is None else bytes(r.text)))
        yield [(i, terms) for i, terms in found.items() if terms]


def search_index(index: DataFrame, n: int, items: list[tuple], item_type: T.DataType, k: int) -> DataFrame:
    """(item_id, doc_id, score): at least the k best documents of every item."""
    df = document_counts(index, set().union(*(terms for _, terms in items)))
    weight = {w: math.floor(1000 * math.log((2 * n + 2) / (2 * c + 1))) for w, c in df.items()}
    words = sorted(w for w, x in weight.items() if x > 0)
    place = {w: p for p, w in enumerate(words)}
    asked = [(i, np.array(sorted(place[w] for w in terms if w in place), np.int64)) for i, terms in items]
    asked = [(i, terms) for i, terms in asked if len(terms)]
    shared = index.sparkSession.sparkContext.broadcast((
        place, np.array([weight[w] for w in words], np.int64), [terms for _, terms in asked]))

    def run(batches):
        place, weights, wanted = shared.value
        best: list[list] = [[] for _ in wanted]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_ids", "height", "terms", "maps", "maxima")]
            for doc_ids, height, terms, maps, maxima in zip(*columns):
                row = np.full(len(place), -1, np.int64)
                for r, w in enumerate(_terms(terms)):
                    p = place.get(w)
                    if p is not None:
                        row[p] = r
                treap = Treap.unpacked(height, maps, maxima)
                for g in range(0, len(wanted), GROUP):
                    here = [terms[row[terms] >= 0] for terms in wanted[g:g + GROUP]]
                    if any(map(len, here)):
                        part = best[g:g + GROUP]
                        search_block(treap, doc_ids, [row[t] for t in here], [weights[t] for t in here], k, part)
                        best[g:g + GROUP] = part
        found = [(i, d, s) for i, b in enumerate(best) for s, d in b]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*found) if found else ((), (), ()), (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    found = batched(index.select("doc_ids", "height", "terms", "maps", "maxima"), run, "item int, doc_id long, score long")
    ids = index.sparkSession.createDataFrame([(p, i) for p, (i, _) in enumerate(asked)], T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)]))  # of at most ITEM_BYTES of items
    return found.join(F.broadcast(ids), "item").select("item_id", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents with score above 0 of every item."""
    index, n, _ = build_index(docs)
    kind = items.schema["item_id"].dataType
    out = None
    for block in item_blocks(items):
        found = search_index(index, n, block, kind, k) if block else None
        out = found if out is None else out if found is None else out.union(found)
    if out is None:
        out = items.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked_rows = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked_rows.select("item_id", "rank", "doc_id", "score")
