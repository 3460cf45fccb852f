"""Operator 12 against a trie built in memory, at several cuts of its shards."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import conversation_trie as trie


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), mark, (role, text)))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(paths):
    nodes = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            node = nodes.setdefault(tuple(turns[:d]), {"all": [], "ends": []})
            node["all"].append(c)
            if d == len(turns):
                node["ends"].append(c)
    children = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:len(p)] == p] for p in nodes}

    def sums(p):
        own = (len(nodes[p]["all"]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        below = [sums(q) for q in children[p]]
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)

    return sorted((min(x["all"]), len(p), min(nodes[p[:-1]]["all"]) if p else None, len(x["all"]), len(children[p]), *sums(p),
                   hashlib.sha256(",".join(map(str, sorted(x["ends"]))).encode()).hexdigest()) for p, x in nodes.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    assert df.columns == COLUMNS and all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    return sorted(tuple(r) for r in df.collect())


def rows_of(seed, n=120):
    rng = random.Random(seed)
    turns = [("user", "hi there"), ("user", "a  b\tc"), (None, "x"), ("user", None), ("", ""), ("assistant", "ja"), ("us", "er")]
    rows = []
    for c in rng.sample(range(-40, 400), n) + [20 * k for k in range(3)]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, t if rng.random() < 0.9 else None, *rng.choice(turns[: 2 + 5 * (t % 2)])))
    rows += [(500 + k, t, "user", f"same {t}") for k in range(40) for t in range(4)]        # a group of copies
    rows += [(700, t, "user", "long" if t < 30 else str(t)) for t in range(60)]
    rows += [(701, t, "user", "long" if t < 30 else str(-t)) for t in range(60)]            # parts after thirty turns
    rows += [(None, 1, "user", "nobody"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("shard,skeleton,chunk", [(250_000, 1 << 16, 12), (25, 1 << 16, 12), (3, 40, 2), (1, 1 << 16, 0)])
def test_trie_equals_one_built_in_memory(spark, monkeypatch, shard, skeleton, chunk):
    monkeypatch.setattr(trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(trie, "SKELETON", skeleton)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "FLUSH", 7)
    rows = rows_of(shard)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    wide = table.withColumn("N_convs", F.lit("x")).withColumn("depth", F.lit(None).cast("int")).withColumn("path", F.lit(1))
    assert found(trie.shared_prefix_trie(wide)) == brute(rebuilt(rows))


def test_a_skeleton_of_several_shards_is_used(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 25)
    table = spark.createDataFrame(rows_of(5), "conv_id long, turn long, role string, text string")
    paths = trie.distinct_paths(trie.ordered_turns(table)).cache()
    skeleton = trie.Skeleton(trie.splitters(paths))
    shards = {skeleton.shard(bytes(r.path)) for r in paths.collect()}
    assert len(skeleton.cuts) > 4 and len(shards) > 4 and skeleton.cuts == sorted(set(skeleton.cuts))


def test_empty_table_and_turnless_conversations(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert found(trie.shared_prefix_trie(spark.createDataFrame([], kind))) == []
    assert found(trie.shared_prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], kind))) == []
    # 1 has h = 3 and one turn of its own, and there is no conversation 0: nothing is left of it
    assert zlib.crc32(b"1") % 4 == 3
    one = found(trie.shared_prefix_trie(spark.createDataFrame([(1, 1, "a", "b")], kind)))
    assert one == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]
    assert len(found(trie.conversation_trie(spark.createDataFrame([(1, 1, "a", "b")], kind)))) == 2
