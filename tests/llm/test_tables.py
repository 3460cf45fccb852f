"""Operators that compare rows: 2 (sharding), 4 (Jaccard join), 5 (passages), 7 (byte strings),
9 (vectors), each against brute force, with edge rows."""

import bisect
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import components, decontaminate, jaccard_join, sharding, sketch, spans, substring_dedup
from ledgerlens.llm import suffix_dedup, vector_search
from ledgerlens.llm.common import space_words


@pytest.fixture(autouse=True)
def small_sketch(monkeypatch):
    monkeypatch.setattr(sketch, "WIDTH", 1 << 18)


def corpus(seed=1, n=60):
    """Texts with exact copies, near copies, shared passages, repeats inside a text and edge rows."""
    rng = random.Random(seed)
    word = [f"{a}{b}" for a in ("lo", "Mi", "ra", "tu", "ne") for b in ("k", "ster", "vo", "n,", "é")]
    prose = lambda n: " ".join(rng.choices(word, k=n))
    base, passage = prose(160), prose(70)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (6, "A b"), (7, "a b")]
    for k in range(10, 10 + n):
        kind = k % 6
        if kind == 0:
            text = prose(rng.randint(1, 120))
        elif kind == 1:
            text = base if k % 4 else base.upper()
        elif kind == 2:
            w = base.split()
            for _ in range(k % 5):
                w[rng.randrange(len(w))] = f"new{rng.randrange(50)}"
            text = " ".join(w)
        elif kind == 3:
            text = prose(20) + " " + passage + "\n" + prose(20)
        elif kind == 4:
            once = prose(60)
            text = once + " " + prose(5) + " " + once
        else:
            text = "ab" * 300 + prose(3)
        rows.append((k, text))
    rows += [(500, rows[12][1]), (500, rows[12][1]), (500, "quite " + prose(80)), (None, base), (None, "alone " + prose(9))]
    return rows


# -- 2 -------------------------------------------------------------------------------------

def check_shards(rows, got, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((x or "").encode()) + 8, zlib.crc32((x or "").encode())) for i, x in rows)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    counts = [len(v) for v in slots.values()]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shards_are_level_and_gapless(make_docs):
    rows = corpus() + [(1000 + k, "same text") for k in range(900)]
    got = sharding.shard_documents(make_docs(rows), 24).collect()
    check_shards(rows, got, 24)
    assert 0 < sum(r.overflowed for r in got) < 0.25 * len(got)


def test_sharding_moves_few_rows_when_one_comes(make_docs):
    rows = [(k, str(k)) for k in range(2400)]
    first = {r.doc_id: r.shard for r in sharding.shard_documents(make_docs(rows), 24).collect()}
    more = {r.doc_id: r.shard for r in sharding.shard_documents(make_docs(rows + [(9999, "x")]), 24).collect()}
    assert sum(first[k] != more[k] for k in first) < 0.05 * len(rows)


def brute_ring(positions, shards):
    """(position, shard) -> rows, by a walk round the ring; positions: one for each row."""
    node = lambda s, r: xxhash.xxh64_intdigest(struct.pack("<q", r), xxhash.xxh64_intdigest(
        struct.pack("<i", s), xxhash.xxh64_intdigest(b"node", 42)))
    nodes = {}
    for s in range(shards):
        for r in range(sharding.VNODES):
            at = node(s, r) % sharding.RING  # 2^16 divides 2^64: the sign does not matter
            nodes[at] = min(s, nodes.get(at, s))
    order = sorted(nodes)
    n = Counter(positions)
    cap = [len(positions) // shards + (s < len(positions) % shards) for s in range(shards)]
    room, out, over = list(cap), Counter(), Counter()
    for p in sorted(n):
        k = bisect.bisect_left(order, p) % len(order)
        s = nodes[order[k]]
        kept = min(n[p], room[s])
        room[s] -= kept
        out[p, s] += kept
        over[k, p] += n[p] - kept
    queue = []
    for turn in range(2):
        for k, at in enumerate(order):
            if not turn:
                queue += [[p, c] for (x, p), c in sorted(over.items()) if x == k and c]
            s = nodes[at]
            while queue and room[s]:
                take = min(queue[0][1], room[s])
                out[queue[0][0], s] += take
                room[s] -= take
                queue[0][1] -= take
                if not queue[0][1]:
                    queue.pop(0)
    return +out


@pytest.mark.parametrize("shards", [24, 25])
def test_shards_are_those_of_a_walked_ring(spark, make_docs, shards):
    rows = [(k, str(k)) for k in range(1500)] + [(7, "hot")] * 600 + [(None, "none")] * 200
    docs = make_docs(rows).repartition(5)
    got = sharding.shard_documents(docs, shards)
    found = Counter()
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32")).otherwise(F.xxhash64("doc_id"))
    for r in got.select(F.pmod(key, F.lit(sharding.RING)).cast("int").alias("position"), "shard").collect():
        found[r.position, r.shard] += 1
    positions = [p for (p, _), c in found.items() for _ in range(c)]
    assert found == brute_ring(positions, shards)
    check_shards(rows, got.collect(), shards)


def test_a_further_shard_moves_few_rows(spark, make_docs):
    """A 25th shard takes 1/25 of all rows; what moves between old shards is overflow only."""
    rows = [(k, str(k)) for k in range(12000)]
    docs = make_docs(rows)
    old = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 24).collect()}
    new = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 25).collect()}
    moved = [k for k in old if old[k] != new[k]]
    assert sum(new[k] == 24 for k in old) == 480
    assert len(moved) < 0.08 * len(rows)
    ring = {n: {r.position: r.shard for r in sharding.ring(spark, n).collect()} for n in (24, 25)}
    assert {ring[25][p] for p in ring[24] if ring[24][p] != ring[25][p]} == {24}  # arcs go to the new shard only


def test_sharding_uses_no_python(make_docs):
    plan = sharding.shard_documents(make_docs(corpus()), 24)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sharding_an_empty_table_and_one_row(make_docs):
    assert sharding.shard_documents(make_docs([]), 24).count() == 0
    check_shards([(7, None)], sharding.shard_documents(make_docs([(7, None)]), 24).collect(), 24)


# -- 4 -------------------------------------------------------------------------------------

def brute_components(rows, gram, num, den):
    sets = []
    for _, x in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets.append({tuple(w[s:s + gram]) for s in range(max(1, len(w) - gram + 1))} if w else set())
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                top[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        ids.setdefault(find(k), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(str(i), len(sets[k]), str(least[find(k)])) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("gram,num", [(4, 85), (5, 80), (2, 50)])
def test_components_match_brute_force(make_docs, gram, num):
    rows = corpus(gram)
    got = jaccard_join.jaccard_components(make_docs(rows), gram, num, 100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        brute_components(rows, gram, num, 100))


def test_components_of_random_overlapping_sets(make_docs):
    """Many pairs near the threshold, in lists whose pivots link only some of them."""
    rng = random.Random(9)
    pool = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(120):
        w = pool[:rng.choice([12, 20, 40])]
        for _ in range(rng.randint(0, 4)):
            w = w[:(at := rng.randrange(len(w)))] + [f"u{rng.randrange(4)}"] + w[at + rng.randint(0, 1):]
        rows.append((k, " ".join(w)))
    got = jaccard_join.jaccard_components(make_docs(rows), 2, 80, 100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        brute_components(rows, 2, 80, 100))


@pytest.mark.parametrize("gram,num,near", [(4, 85, False), (2, 80, True)])
def test_every_link_is_given(make_docs, gram, num, near):
    """Links of classes and their numbers against all pairs, in groups that pivots link only in part."""
    rows = corpus(gram)
    if near:
        rng = random.Random(11)
        pool = [f"t{k}" for k in range(50)]
        for k in range(90):
            w = pool[:rng.choice([20, 40])]
            for _ in range(rng.randint(0, 4)):
                w = w[:(at := rng.randrange(len(w)))] + [f"u{rng.randrange(4)}"] + w[at + rng.randint(0, 1):]
            rows.append((1000 + k, " ".join(w)))
    found, members = jaccard_join.jaccard_links(make_docs(rows), gram, num, 100)
    sets = {}
    for _, x in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        if w:
            sets[frozenset(tuple(w[s:s + gram]) for s in range(max(1, len(w) - gram + 1)))] = None
    sets = list(sets)
    want = sorted((len(a & b), *sorted((len(a), len(b)))) for k, a in enumerate(sets) for b in sets[:k]
                  if 100 * len(a & b) >= num * len(a | b))
    links = found.collect()
    assert sorted((r.overlap, *sorted((r.n_a, r.n_b))) for r in links) == want and len(want) > 10
    assert len({(r.class_a, r.class_b) for r in links}) == len(links) and all(r.class_a < r.class_b for r in links)
    got = members.collect()
    degree = Counter(c for r in links for c in (r.class_a, r.class_b))
    assert len(got) == len(rows) and all(r.n_links == degree[r.class_id] for r in got)
    assert len({r.class_id for r in got if r.class_id is not None}) == len(sets)


def test_one_of_each_keeps_the_smallest(make_docs):
    rows = corpus()
    got = jaccard_join.one_of_each(make_docs(rows)).collect()
    want = Counter()
    seen = set()
    for (i, x), (_, n, top) in sorted(zip(rows, brute_components(rows, 5, 80, 100)), key=lambda p: (p[0][0] is None, p[0][0] or 0)):
        if n == 0:
            want[i] += 1
        elif top == "None" or str(i) == top and top not in seen:
            want[i] += 1
            seen.add(top)
    assert Counter(r.doc_id for r in got) == want


def test_components_helper(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (120, 3)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {1}


def test_join_of_empty_tables(make_docs):
    assert jaccard_join.jaccard_components(make_docs([])).count() == 0
    assert jaccard_join.jaccard_components(make_docs([(1, None), (2, "")])).count() == 2


# -- 5 and 7 -------------------------------------------------------------------------------

def brute_passages(rows, window):
    least, lists = {}, []
    for i, x in rows:
        w = space_words(None if x is None else x.encode())
        lists.append(w)
        if i is not None:
            for s in range(len(w) - window + 1):
                key = tuple(w[s:s + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for (i, _), w in zip(rows, lists):
        gone = set()
        for s in range(len(w) - window + 1) if i is not None else ():
            if least[tuple(w[s:s + window])] < i:
                gone |= set(range(s, s + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("width", [1 << 18, 1 << 16])
def test_passages_match_brute_force(make_docs, monkeypatch, width):
    """Also with a sketch so small that most anchors collide: nothing is lost, nothing is added."""
    monkeypatch.setattr(sketch, "WIDTH", width)
    monkeypatch.setattr(sketch, "FLUSH", 500)
    rows = corpus(4, 90) + [(900, "again " * 400), (901, "again " * 400), (902, "x " * 30_000)]
    got = substring_dedup.dedup_passages(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_passages(rows, 50)


def test_passages_repeated_inside_the_least_document(make_docs):
    """C P D twice in document 2, A P B in document 1: P goes from both places, also where two
    texts share the doc_id, and the document after them loses its whole C P D."""
    rng = random.Random(12)
    prose = lambda n: " ".join(f"w{rng.randrange(10_000)}" for _ in range(n))
    for n in (60, 51, 90):
        a, b, c, d, p = prose(40), prose(40), prose(30), prose(30), prose(n)
        twice = " ".join([c, p, d, prose(70), c, p, d])
        rows = [(1, f"{a} {p} {b}"), (2, twice), (2, f"{c} {p} {d} {prose(9)}"), (2, twice), (3, f"{prose(5)} {c} {p} {d}")]
        got = substring_dedup.dedup_passages(make_docs(rows)).collect()
        want = brute_passages(rows, 50)
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
        assert sorted(x[2] for x in want if x[0] == "2") == [n, 2 * n, 2 * n]


def test_passages_keep_other_columns(make_docs):
    docs = make_docs(corpus()).withColumns({"n_words": F.lit("clash"), "spans": F.lit(1), "row": F.lit(2)})
    got = substring_dedup.dedup_passages(docs, keep=True)
    assert got.columns == [c for c in docs.columns if c != "n_words"] + ["n_words", "n_removed", "kept_sha256"]
    same = {(r.doc_id, r.text) for r in got.where("n_removed = 0").collect()}
    assert same <= {(r.doc_id, r.text) for r in docs.collect()}
    assert substring_dedup.dedup_passages(make_docs([])).count() == 0


def brute_bytes(rows, window):
    seen = Counter(t[s:s + window] for t in ((x or "").encode() for _, x in rows) for s in range(len(t) - window + 1))
    out = []
    for i, x in rows:
        t = (x or "").encode()
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - window + 1):
            if seen[t[s:s + window]] > 1:
                gone[s:s + window] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((str(i), len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_byte_strings_match_brute_force(make_docs, batches):
    rows = corpus(6, 70) + [(900, "abc" * 150), (901, "q" * 199), (902, "q" * 200), (903, "z" * 201)]
    alone = " ".join(f"only{k}here" for k in range(60))
    rows += [(None, alone), (None, "p" + alone[:150]), (950, alone[::-1]), (950, alone[::-1]), (951, "short"), (951, "short")]
    got = suffix_dedup.dedup_bytes(make_docs(rows), batches=batches).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows, 200)


def test_levels_double(make_docs):
    index = suffix_dedup.SuffixIndex()
    for k in range(7):
        index.add(spans.keyed(make_docs([(k, f"text number {k} " * 40)])))
    assert sorted(index.levels) == [0, 1, 2]
    assert suffix_dedup.dedup_bytes(make_docs([])).count() == 0


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    piece = rng.integers(0, 256, 300, dtype=np.uint8).tobytes()
    found = []
    for left in (0, 17, 150):
        b = spans.Blocks(suffix_dedup.symbols(rng.integers(0, 256, left, dtype=np.uint8).tobytes() + piece), 200, 64)
        anchors = np.repeat(b.anchor, b.until - b.first)
        found.append(anchors[left:left + 101])
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


# -- 9 -------------------------------------------------------------------------------------

def brute_nearest(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, m = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for q, (i, v) in enumerate(good):
        if i % every == 0:
            d = np.sqrt(((m - v) ** 2).sum(1))
            order = [o for o in np.lexsort((ids, d)) if o != q][:k]
            out[i] = [(int(ids[o]), float(d[o])) for o in order]
    return out


def vectors(n=1500):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((12, 8)) * 4
    rows = [(k, (centre[k % 12] + rng.standard_normal(8)).astype(np.float32).tolist()) for k in range(n)]
    same = rows[40][1]
    rows += [(2000 + k, same) for k in range(0, 60)]
    rows += [(3000, None), (3100, [0.0] * 8), (3200, [1.0, None] + [0.0] * 6), (3300, [float("nan")] + [1.0] * 7),
             (3400, [float("inf")] + [1.0] * 7), (3500, [1.0, 2.0]), (3600, []), (None, rows[0][1])]
    return rows


def test_search_recall_and_exact_scores(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "key": F.lit("x")})
    got = {}
    for r in vector_search.search(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute_nearest(rows, 100, 10)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        exact = dict(want[q])
        hits += len({v for _, v, _ in found} & set(exact))
        assert all(abs(s - exact[v]) < 1e-12 for _, v, s in found if v in exact)
    assert hits / (10 * len(want)) >= 0.9
    assert [v for _, v, _ in got[2000]] == [v for v, _ in want[2000]]  # a tie of many, to the smaller ids


def test_search_of_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (100, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in vector_search.search(few).collect())
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, 5 ** 0.5), (100, 1, 0, 0.0), (100, 2, 1, 5 ** 0.5)]
    assert vector_search.search(few.limit(0)).count() == 0


def test_search_of_several_lengths_and_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [3.0, 0.0]), (1, [0.0, 2.0]), (100, [1.0, 0.0, 0.0]), (7, [0.0, 0.0, 4.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in vector_search.search(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    first = [(0, 1, 0, 0.0), (0, 2, 0, 2.0), (0, 3, 1, round(5 ** 0.5, 6))]          # the query [1, 0]
    other = [(0, 1, 0, 2.0), (0, 2, 0, 2.0), (0, 3, 1, round(13 ** 0.5, 6))]         # the query [3, 0]
    assert got == sorted(first + other + [(100, 1, 7, round(17 ** 0.5, 6))])


def test_scan_abandons_no_near_candidate():
    rng = np.random.default_rng(2)
    block = rng.standard_normal((800, 32)) * np.linspace(3, 0.1, 32)
    rotation, _ = np.linalg.qr(rng.standard_normal((32, 32)))
    lost = 0
    for i, alive, _ in vector_search.scan(block[:40], block, rotation, 10):
        d = ((block - block[i]) ** 2).sum(1)
        lost += len(set(np.argsort(d)[:11].tolist()) - set(alive.tolist()))
    assert lost <= 0.02 * 40 * 11


def test_benchmark_blocks_cover_every_item(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    bench = spark.createDataFrame([(k, f"item number {k} of many") for k in range(50)], "item_id long, text string")
    parts = [(list(rows), last) for rows, last in decontaminate.blocks(bench)]
    assert len(parts) > 5 and [last for _, last in parts] == [False] * (len(parts) - 1) + [True]
    assert sorted(i for rows, _ in parts for i, _ in rows) == list(range(50))
