"""Operator 12: the prefix trie of conversations by a splitter skeleton.

1. A conversation's path is the digests of its turns one after the other, 16 bytes each, so the
   sorted order of paths is the preorder of the trie. Equal paths become one row first: their ids
   are sorted and joined in chunks of ``CHUNK`` ids, and one sorted scan feeds the chunks of each
   path to its SHA-256.
2. Splitters cut the sorted paths into shards of about ``SHARD_TURNS`` turns. They come from a
   sample chosen by hash, each cut to the shortest prefix that parts it from the path before it.
   The prefixes of the splitters are the skeleton, a trie of at most ``SKELETON`` nodes, which is
   broadcast: only its nodes can have members in several shards.
3. Every shard is sorted and walked once with a stack of open nodes. A node outside the skeleton
   is finished there, its members being consecutive; a skeleton node gives one partial aggregate a
   shard. Partial aggregates are summed by a shuffle, and the skeleton is folded bottom-up.

Sample, splitters and skeleton bounds decide where the work is cut and never a result. A
conversation is held as digests and counts (some 40 bytes a turn), never as text, and one shard's
nodes wait in a task until their parent is closed.

Defined results: rows with a null conv_id take no part; a null role or text is empty; turns of
equal number are ordered by the MD5 of their length-marked role and text (null numbers first), so
repeated rows are turns of their own; an empty table gives no nodes; other columns are ignored."""

from __future__ import annotations

import bisect
import hashlib
from array import array

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, discard, scratch, written

#: Bytes of a turn's digest.
TURN = 16
#: Turns of a shard; most shards; nodes of the skeleton; turns of a splitter; ids of a chunk (a power of 2).
SHARD_TURNS = 250_000
SHARDS = 4096
SKELETON = 1 << 16
DEEPEST = 1024
CHUNK = 12
#: Sampled paths for each splitter.
SAMPLED = 8
#: Finished nodes a shard hands on at once.
FLUSH = 20_000

#: Above every id: the least member of a skeleton node all of whose members lie in skeleton children.
NOBODY = (1 << 63) - 1
WORD = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256().digest()


# -- paths ---------------------------------------------------------------------------------

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, as digest (hex) and words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"), digest.alias("digest"),
                 F.regexp_count(text, F.lit(WORD)).alias("words")).alias("x"))
    turns = F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(x.digest.alias("digest"), x.words.alias("words")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def sharing_first_turns(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c with its first h = crc32(decimal c) mod ``most`` turns replaced by those
    of conversation c - c mod ``group``."""
    head = turns.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = turns.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    return own.join(head, "base", "left").select("conv_id", F.expr("""
        concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, greatest(size(turns) - h, 0)))""").alias("turns"))


def distinct_paths(turns: DataFrame) -> DataFrame:
    """(path, words, n, least, ends): one row for each path, with its conversations' number, least
    id and, as 32 bytes, the SHA-256 of their sorted, comma-joined ids."""
    hexed = F.array_join(F.transform("turns", lambda x: x.digest), "")
    rows = turns.select("conv_id", F.md5(hexed).alias("pid"), F.unhex(hexed).alias("path"),
                        F.transform("turns", lambda x: x.words).alias("words"),
                        F.shiftright("conv_id", CHUNK).alias("chunk"))
    chunks = rows.groupBy("pid", "chunk").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"),
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"),
        F.first("words").alias("words"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return batched(chunks.repartition(parts, "pid").sortWithinPartitions("pid", "chunk"), _joined_chunks,
                   "path binary, words array<int>, n long, least long, ends binary")


def _joined_chunks(batches):
    """Chunks come sorted by path and id; the ids of a path pass through its hash chunk by chunk."""
    done: list[list] = [[], [], [], [], []]
    pid = sha = None

    def table():
        kinds = (pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(done, kinds)],
                                          names=["path", "words", "n", "least", "ends"])

    for batch in batches:
        columns = [batch.column(c) for c in ("pid", "ids", "n", "least", "path", "words")]
        for key, ids, n, least, path, words in zip(*(c.to_pylist() for c in columns)):
            if key != pid:
                if sha is not None:
                    done[4].append(sha.digest())
                    if len(done[0]) >= FLUSH:
                        yield table()
                        done = [[], [], [], [], []]
                pid, sha = key, hashlib.sha256(ids.encode())
                for column, value in zip(done, (path, words, n, least)):
                    column.append(value)
            else:
                sha.update(b"," + ids.encode())
                done[2][-1] += n
    if sha is not None:
        done[4].append(sha.digest())
        yield table()


# -- splitters and skeleton ----------------------------------------------------------------

def common_turns(a: bytes, b: bytes) -> int:
    k, most = 0, min(len(a), len(b))
    while k < most and a[k:k + TURN] == b[k:k + TURN]:
        k += TURN
    return k // TURN


def splitters(paths: DataFrame) -> list[bytes]:
    """Ascending splitters; at most ``SHARDS``, of at most ``DEEPEST`` turns each."""
    size = paths.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("path")).alias("bytes")).first()
    weight = size.n + (size.bytes or 0) // TURN
    shards = min(SHARDS, weight // SHARD_TURNS + 1)
    if shards == 1:
        return []
    every = max(1, size.n // (SAMPLED * shards))
    step = weight / shards / every

    def cut(batches):
        last, held = b"", 0.0
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                held += 1 + len(path) // TURN
                if held >= step:
                    held -= step * (held // step)
                    k = common_turns(last, path) + 1
                    if k <= DEEPEST:
                        found.append(path[:k * TURN])
                last = path
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["cut"])

    # some SAMPLED * SHARDS paths, in one sorted scan
    sample = paths.select("path").where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0)
    return [bytes(r.cut) for r in batched(sample.repartition(1).sortWithinPartitions("path"), cut, "cut binary").collect()]


class Skeleton:
    """The trie of splitters: node 0 is the root; (node, digest) -> child. Splitters that would
    make it larger than ``SKELETON`` nodes are left out, the shallow ones last."""

    def __init__(self, cuts: list[bytes]):
        self.children: dict[tuple[int, bytes], int] = {}
        self.parent = [-1]
        kept = []
        for cut in sorted(cuts, key=lambda c: (len(c), c)):
            steps = [cut[k:k + TURN] for k in range(0, len(cut), TURN)]
            if len(self.parent) + len(steps) > SKELETON:
                continue
            node = 0
            for digest in steps:
                child = self.children.setdefault((node, digest), len(self.parent))
                if child == len(self.parent):
                    self.parent.append(node)
                node = child
            kept.append(cut)
        self.cuts = sorted(kept)

    def shard(self, path: bytes) -> int:
        return bisect.bisect_right(self.cuts, path)


NODES = ("skeleton int, conv_id long, depth long, parent long, above int, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, words long, ends binary")


class Walk:
    """Walks sorted paths with a stack of open nodes. ``rows`` are the finished nodes, and for open
    skeleton nodes that close one partial aggregate each."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.path = b""
        self.open: list[list] = []   # skeleton id (-1: none), n, least, children, leaves, saved, words, ends
        self.waiting: list[list[int]] = []  # rows, by depth, whose parent is open
        self.columns = [array("q") for _ in range(10)]
        self.ends: list[bytes | None] = []
        self._push(0, 0)

    def _push(self, skeleton: int, words: int) -> None:
        self.open.append([skeleton, 0, None, 0, 0, 0, words, None])
        self.waiting.append([])

    def _emit(self, *values, ends) -> int:
        for column, value in zip(self.columns, values):
            column.append(value)
        self.ends.append(ends)
        return len(self.ends) - 1

    def _close(self) -> None:
        skeleton, n, least, children, leaves, saved, words, ends = self.open.pop()
        depth = len(self.open)
        if skeleton >= 0:
            self.waiting.pop()
            self._emit(skeleton, NOBODY if least is None else least, depth, 0, -1, n, children, leaves, saved, words, ends=ends)
            return
        leaves = leaves or 1
        saved += (n - 1) * words
        parent = self.columns[3]
        for row in self.waiting.pop():
            parent[row] = least
        above = self.open[-1]
        row = self._emit(-1, least, depth, 0, above[0], n, children, leaves, saved, words, ends=ends)
        if above[0] < 0:
            self.waiting[-1].append(row)
        above[1] += n
        above[2] = least if above[2] is None else min(above[2], least)
        above[3] += 1
        above[4] += leaves
        above[5] += saved

    def add(self, path: bytes, words: list[int], n: int, least: int, ends: bytes) -> None:
        shared = common_turns(self.path, path)
        while len(self.open) > shared + 1:
            self._close()
        for k in range(shared, len(path) // TURN):
            above = self.open[-1][0]
            child = self.skeleton.children.get((above, path[k * TURN:(k + 1) * TURN]), -1) if above >= 0 else -1
            self._push(child, words[k])
        top = self.open[-1]
        top[1] += n
        top[2] = least if top[2] is None else min(top[2], least)
        top[7] = ends
        self.path = path

    def end(self) -> None:
        while self.open:
            self._close()

    @property
    def settled(self) -> bool:
        """No row waits for its parent."""
        return not any(self.waiting)

    def taken(self) -> pa.RecordBatch:
        out = [pa.array(c, pa.int64()) for c in self.columns]
        none = [pc.equal(c, -1) for c in (out[0], out[4])]
        null = pa.scalar(None, pa.int64())
        out[3] = pc.if_else(pc.and_(*none), out[3], null)
        out[0], out[4] = (pc.if_else(x, null, c).cast(pa.int32()) for x, c in zip(none, (out[0], out[4])))
        self.columns = [array("q") for _ in range(10)]
        ends, self.ends = pa.array(self.ends, pa.binary()), []
        return pa.RecordBatch.from_arrays([*out, ends], names=[f.split()[0] for f in NODES.split(", ")])


def shard_nodes(paths: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Deal the paths out to their shards, sort and walk each: the rows of ``NODES``."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton)  # at most SKELETON nodes

    def deal(batches):
        for batch in batches:
            shard = shared.value.shard
            yield pa.RecordBatch.from_arrays([pa.array(map(shard, batch.column("path").to_pylist()), pa.int32()), *batch.columns],
                                             names=["shard", *batch.schema.names])

    def walk(batches):
        state, at = None, None
        for batch in batches:
            names = ("shard", "path", "words", "n", "least", "ends")
            for shard, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if shard != at:
                    if state:
                        state.end()
                        yield state.taken()
                    state, at = Walk(shared.value), shard
                state.add(*row)
                if len(state.ends) >= FLUSH and state.settled:
                    yield state.taken()
        if state:
            state.end()
            yield state.taken()

    dealt = batched(paths, deal, "shard int, path binary, words array<int>, n long, least long, ends binary")
    dealt = dealt.repartitionById(len(skeleton.cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path")
    return batched(dealt, walk, NODES)


def fold(partial: list, skeleton: Skeleton) -> list[tuple]:
    """(skeleton, conv_id, depth, parent id, n_convs, n_children, n_leaves, saved_tokens, ends) of
    the skeleton's nodes from their summed partial aggregates: children have larger numbers."""
    rows = {r.skeleton: [r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.words, r.ends]
            for r in partial}
    for k in range(len(skeleton.parent) - 1, -1, -1):
        if k not in rows:  # only the root of an empty table
            continue
        least, _, n, _, leaves, saved, words, _ = row = rows[k]
        row[4], row[5] = leaves or 1, saved + (n - 1) * words
        if k:
            up = rows[skeleton.parent[k]]
            up[0], up[2], up[3] = min(up[0], least), up[2] + n, up[3] + 1
            up[4], up[5] = up[4] + row[4], up[5] + row[5]
    return [(k, r[0], r[1], rows[skeleton.parent[k]][0] if k else None, r[2], r[3], r[4], r[5],
             None if r[7] is None else bytes(r[7])) for k, r in sorted(rows.items())]


def prefix_trie(turns: DataFrame) -> DataFrame:
    """``turns``: conv_id and its turns (digest, words). Per node: conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    with scratch():
        paths = written(distinct_paths(turns), "paths")
        skeleton = Skeleton(splitters(paths))
        nodes = written(shard_nodes(paths, skeleton), "nodes", stays=True)
    partial = nodes.where("skeleton is not null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends"))
    folded = fold(partial.collect(), skeleton)  # at most SKELETON rows
    top = spark.createDataFrame(folded, "skeleton int, conv_id long, depth long, parent long, n_convs long, "
                                        "n_children long, n_leaves long, saved_tokens long, ends binary")
    below = nodes.where("skeleton is null").join(
        F.broadcast(top.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("above_id"))), "above", "left")
    columns = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = [below.select("conv_id", "depth", F.coalesce("parent", "above_id").alias("parent_conv_id"), *columns, "ends"),
             top.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), *columns, "ends")]
    ends = F.lower(F.hex(F.coalesce("ends", F.lit(EMPTY))))
    return parts[0].union(parts[1]).withColumn("ends_sha256", ends).drop("ends")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return prefix_trie(ordered_turns(conversations))


def shared_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations that share their first turns by ``sharing_first_turns``."""
    turns = written(ordered_turns(conversations), "turns")
    out = prefix_trie(sharing_first_turns(turns))
    discard(turns)
    return out
