"""Operator 4: exact n-gram Jaccard self-join with skipping by set relations.

1. Every text becomes a set of shingle hashes. Equal sets are one class, so copies are joined
   once. Shingles are ordered rarest first by a fixed-size frequency sketch of all rows (any
   order is exact; a good one keeps index lists short). Two sets that reach the threshold share
   a shingle of their prefixes, so only prefixes are indexed.
2. Index-level skipping: a list is one shingle and one size block, entries carry their position;
   a block of sizes out of reach is never read, and a pair is skipped when the positions leave
   too few shingles for the overlap that both sizes need. Shingles that a count-min sketch of
   all prefixes counts once are left out, since they join nothing.
3. Answer-level skipping: in each list one set (the pivot) is compared exactly with all others,
   and those overlaps are the computed answers from which other pairs are derived: for y and z
   with pivot x, |y & z| is at most min(|x & y|, |x & z|) + min(|y - x|, |z - x|). Pairs that the
   bound rules out, and pairs that links with pivots have already put into one component, are
   not compared; all others are.

So every link between different texts shapes the components, while a group of G near copies
costs about G comparisons for each of its lists and not G * G.

Shingles are compared by 64-bit hashes.

Defined results: null, empty and blank texts have the empty set, link with nothing and are their
own component; fewer words than a shingle has make one shingle of all; equal texts, repeated rows
and ties link as any equal sets do; a row with a null doc_id joins, and its component is the
smallest doc_id reached, null if there is none; every input row gives one output row."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, free_name, mix64, scratch, signed, space_words, texts_of, word_hashes, written
from .components import components
from .sketch import SPREAD, maybe_repeated, repeated_bitmap
from .spans import row_bitmap, texts_with

#: Cells of the frequency sketch (32-bit counters, broadcast).
CELLS = 1 << 20
_CHUNK = 1 << 16


def shingle_set(text: bytes | None, gram: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``gram`` words."""
    h = word_hashes(space_words(text, lower=True))
    if not len(h):
        return h
    n = max(1, len(h) - gram + 1)
    out = np.full(n, min(gram, len(h)), np.uint64)
    for k in range(min(gram, len(h))):
        out = mix64(out * np.uint64(0x9FB21C651E98DF25) + h[k:k + n])
    return np.unique(out)


def frequencies(docs: DataFrame, gram: int) -> np.ndarray:
    """Hashed counts of all rows' shingles; partial sketches merge in two levels."""
    def run(batches):
        counts, any_row = np.zeros(CELLS, np.int64), False
        for batch in batches:
            for text in texts_of(batch):
                s = shingle_set(text, gram)
                any_row |= len(s) > 0
                np.add.at(counts, (s & np.uint64(CELLS - 1)).astype(np.int64), 1)
        if any_row:
            parts = [c.tobytes() for c in counts.astype(np.uint32).reshape(-1, _CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())],
                                             names=["chunk", "counts"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_CHUNK, np.uint32)
        for c in pdf["counts"]:
            part = np.frombuffer(c, np.uint32)
            total += np.minimum(part, np.uint32(0xFFFFFFFF) - total)  # saturates
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "counts": [total.tobytes()]})

    schema = "chunk int, counts binary"
    parts = batched(docs.select("text"), run, schema).withColumn("salt", F.spark_partition_id() % SPREAD)
    merged = parts.groupBy("chunk", "salt").applyInPandas(added, schema).groupBy("chunk").applyInPandas(added, schema)
    out = np.zeros((CELLS // _CHUNK, _CHUNK), np.uint32)
    for r in merged.toLocalIterator():
        out[r.chunk] = np.frombuffer(bytes(r.counts), np.uint32)
    return out.ravel()


class Threshold:
    """den * overlap >= num * union, in integers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def need(self, a: str, b: str) -> str:
        """SQL: least overlap of sets of sizes a and b."""
        return f"(({self.num}L * ({a} + {b}) + {self.num + self.den - 1}L) div {self.num + self.den}L)"

    def block(self, n: str) -> str:
        """SQL: size block; sizes in reach of each other lie in the same or neighbouring blocks."""
        return f"cast(floor(ln({n}) / {float(np.log(self.den / self.num))!r} + 1e-9) as int)"


def sets_of(docs: DataFrame, gram: int, t: Threshold) -> DataFrame:
    """Per row: doc_id, row_key, n, sid (names the set) and its prefix, rarest shingle first."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies(docs, gram))

    def run(batches):
        counts = shared.value
        for batch in batches:
            sid, size, prefix = [], [], []
            for text in texts_of(batch):
                s = shingle_set(text, gram)
                size.append(len(s))
                sid.append(xxhash.xxh3_64_intdigest(s.tobytes()) if len(s) else 0)
                order = np.lexsort((s, counts[(s & np.uint64(CELLS - 1)).astype(np.int64)]))
                prefix.append(s[order[:t.prefix(len(s))]].view(np.int64) if len(s) else s.view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row_key"), pa.array(size, pa.int64()),
                pa.array(np.array(sid, np.uint64).view(np.int64)), pa.array(prefix, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "n", "sid", "prefix"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return batched(rows, run, T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("row_key", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("sid", T.LongType()),
        T.StructField("prefix", T.ArrayType(T.LongType()))]))


def index_entries(classes: DataFrame) -> DataFrame:
    """(token, sid, n, pos) for the prefix shingles that may occur in two sets."""
    def lists(batch):
        column = batch.column("prefix")
        return [np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).view(np.uint64)]

    shared = classes.sparkSession.sparkContext.broadcast(repeated_bitmap(classes.select("prefix"), lists))

    def run(batches):
        for batch in batches:
            column = batch.column("prefix")
            sizes = np.diff(column.offsets.to_numpy())
            tokens = lists(batch)[0]
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(maybe_repeated(tokens, shared.value))
            take = pa.array(row[kept])
            yield pa.RecordBatch.from_arrays([signed(tokens[kept]), batch.column("sid").take(take), batch.column(
                "n").take(take), pa.array(pos[kept], pa.int64())], names=["token", "sid", "n", "pos"])

    return batched(classes.select("sid", "n", "prefix"), run, "token long, sid long, n long, pos long")


def overlaps(pairs: DataFrame, classes: DataFrame, docs: DataFrame, gram: int) -> DataFrame:
    """(a, b, o): exact overlap of the sets of each pair. Only texts that a pair names are shuffled,
    once as an ``a`` and once as a ``b``."""
    def named(side: str) -> DataFrame:
        return classes.select(F.col("sid").alias(side), F.col("row_key").alias(f"key_{side}"))

    named_pairs = written(pairs.join(named("a"), "a").join(named("b"), "b"), "named")

    def texts(side: str) -> DataFrame:
        bits = row_bitmap(named_pairs.select(F.col(f"key_{side}").alias("row")).distinct())
        key = F.xxhash64("doc_id", "text")
        rows = texts_with(docs.where("text is not null").select(key.alias(f"key_{side}"), F.col("text").alias(
            f"text_{side}"), key.alias("_row")), docs.sparkSession.sparkContext.broadcast(bits))
        # repeated rows are one; by sort-merge at every size, so that what is shuffled grows evenly
        return rows.groupBy(f"key_{side}").agg(F.first(f"text_{side}").alias(f"text_{side}")).hint("merge")

    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            out = []
            for x, y, k in zip(texts_of(batch, "text_a"), texts_of(batch, "text_b"), batch.column("b").to_pylist()):
                if last[0] != k:  # rows come sorted by the pivot's key
                    last = (k, shingle_set(y, gram))
                out.append(len(np.intersect1d(shingle_set(x, gram), last[1], assume_unique=True)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.int64())],
                                             names=["a", "b", "o"])

    joined = named_pairs.join(texts("a"), "key_a").join(texts("b"), "key_b")
    return batched(joined.select("a", "b", "text_a", "text_b"), run, "a long, b long, o long")


def links(sets: DataFrame, docs: DataFrame, gram: int, t: Threshold, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(classes, labels): the distinct sets (sid, n, doc_id: smallest, row_key: one row's), and
    (node, label) over the sets that link with another one. With ``every`` no pair is spared for
    lying in one component, and instead of labels all links (a, b, o: overlap) are the second."""
    classes = written(sets.where("n > 0").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix")), "classes")
    entries = written(index_entries(classes).withColumn("block", F.expr(t.block("n"))), "entries")
    alone = entries.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi")
    entries = written(entries.join(alone.select("token"), "token", "left_semi"), "entries")

    # One pivot for each list, compared with the list's block and the next larger one: the set that
    # has fewest rarer shingles before this one, in a group of near copies the nearest to the middle.
    heads = entries.groupBy("token", "block").agg(F.min(F.struct("pos", "sid", "n")).alias("x"))
    # a head is dealt to both blocks that read its list, so an entry is shuffled once
    dealt = heads.select("token", F.explode(F.array("block", F.col("block") + 1)).alias("block"), "x")
    answers = (entries.join(dealt, ["token", "block"]).where("sid != x.sid").select(
        "sid", "n", "pos", F.col("x.sid").alias("b"), F.col("x.n").alias("n_b"), F.col("x.pos").alias("pos_b")))
    reach = f"{t.den} * least(n, n_b) >= {t.num} * greatest(n, n_b)"
    room = f"1 + least(n - pos, n_b - pos_b) >= {t.need('n', 'n_b')}"
    pairs = answers.where(f"({reach}) and ({room})").select(F.col("sid").alias("a"), "b", "n", "n_b").distinct()
    pairs = written(pairs, "pairs")

    first = written(overlaps(pairs.select("a", "b"), classes, docs, gram).join(pairs, ["a", "b"]), "answers")
    linked = f"{t.den} * o >= {t.num} * (n + n_b - o)"
    labels = first.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0) if every else components(first.where(linked))

    # What is left: pairs of one list in different components that the answers do not settle.
    # Lists of one component have none, so they go before the wider joins.
    heads_of = heads.select("token", "block", F.col("x.sid").alias("b"))
    known = entries.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    if not every:
        known = written(known, "labelled")
        mixed = known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
        known = known.join(mixed.select("token"), "token", "left_semi")
    known = (known.join(heads_of, ["token", "block"])
             .join(first.select(F.col("a").alias("sid"), "b", "o", "n_b"), ["sid", "b"], "left")
             .withColumn("o", F.when(F.col("sid") == F.col("b"), F.col("n")).otherwise(F.col("o"))))
    known = written(known, "known")
    y = known.select("token", *[F.col(c).alias(f"{c}_y") for c in ("sid", "n", "pos", "b", "o", "label")],
                     F.explode(F.array("block", F.col("block") - 1)).alias("list"))
    z = known.select("token", F.col("block").alias("list"), *[
        F.col(c).alias(f"{c}_z") for c in ("sid", "n", "pos", "b", "o", "label")])
    need = t.need("n_y", "n_z")
    apart = "true" if every else "label_y != label_z"
    rest = y.join(z, ["token", "list"]).where(f"""
        {apart} and (n_y > n_z or (n_y = n_z and sid_y > sid_z))
        and {t.den} * n_z >= {t.num} * n_y and 1 + least(n_y - pos_y, n_z - pos_z) >= {need}
        and coalesce(b_y != b_z or least(o_y, o_z) + least(n_y - o_y, n_z - o_z) >= {need}, true)""")
    rest = rest.select(F.col("sid_y").alias("a"), F.col("sid_z").alias("b"), F.col("n_y").alias("n"), F.col(
        "n_z").alias("n_b"), "label_y", "label_z").distinct()
    if every:  # pairs with a pivot have been answered, whichever of both it is
        rest = (rest.join(first.select("a", "b"), ["a", "b"], "left_anti")
                .join(first.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"))
    rest = written(rest, "rest")
    found = overlaps(rest.select("a", "b"), classes, docs, gram).join(rest, ["a", "b"]).where(linked)
    if every:
        both = first.where(linked).select("a", "b", "o").union(found.select("a", "b", "o"))
        return classes, both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "o").distinct()
    merged = components(found.select(F.col("label_y").alias("a"), F.col("label_z").alias("b")))
    top = merged.select(F.col("node").alias("label"), F.col("label").alias("top"))
    single = merged.select("node", F.col("label").alias("label"))
    every = labels.union(single.join(labels, "node", "left_anti"))
    return classes, every.join(top, "label", "left").select("node", F.coalesce("top", "label").alias("label"))


def _labelled(docs: DataFrame, gram: int, t: Threshold) -> tuple[DataFrame, DataFrame]:
    """(sets, members): all rows' sets; sid, doc_id (smallest) and component label of each class."""
    with scratch():
        every = written(sets_of(docs, gram, t), "sets")
        sets = written(every.drop("prefix"), "rows", stays=True)
        classes, labels = links(every, docs, gram, t)
        members = classes.select("sid", "doc_id").join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
            "label", F.coalesce("label", "sid"))
        return sets, written(members, "members", stays=True)


def jaccard_links(docs: DataFrame, gram: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """(links, members). A class is all rows of one set; links are the pairs of classes that link
    (class_a < class_b), with the overlap and both sizes, each once and none left out; members has
    every row's doc_id, n_shingles, class_id (null without words) and n_links, the number of classes
    that its own links with. Rows of one class link with each other, too, and are not paired.

    Links of a group of G different near copies are G * G / 2 by nature; ``jaccard_components`` is
    the way to their groups without them."""
    t = Threshold(num, den)
    with scratch():
        every = written(sets_of(docs, gram, t), "sets")
        rows = written(every.drop("prefix"), "rows", stays=True)
        classes, found = links(every, docs, gram, t, every=True)
        size = classes.select("sid", "n")
        found = (found.join(size.select(F.col("sid").alias("a"), F.col("n").alias("n_a")), "a")
                 .join(size.select(F.col("sid").alias("b"), F.col("n").alias("n_b")), "b"))
        found = written(found.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), F.col("o").alias("overlap"),
                                     "n_a", "n_b"), "links", stays=True)
    degree = (found.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id")
              .agg(F.count(F.lit(1)).alias("n_links")))
    own = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("sid")).alias("class_id"))
    return found, own.join(degree, "class_id", "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(docs: DataFrame, gram: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """n_shingles and component_id of every row: the smallest doc_id reachable by links between
    texts whose sets have den * overlap >= num * union."""
    sets, members = _labelled(docs, gram, Threshold(num, den))
    group = members.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_set = members.join(group, "label").select("sid", "component_id")
    own = sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return sets.where("n > 0").join(of_set, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id").union(own)


def one_of_each(docs: DataFrame, gram: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """All columns of one row of each component, that of the smallest doc_id (a null one only
    where no row has an id). Texts without words link with nothing and all stay."""
    sets, members = _labelled(docs, gram, Threshold(num, den))
    key = free_name(docs, "_row_key")
    first = (sets.where("n > 0").join(members.select("sid", "label"), "sid").groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("x"))
             .select(F.col("x.row_key").alias(key)))
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    wordless = F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    kept = rows.where(~wordless).join(first, key, "left_semi").dropDuplicates([key])
    return kept.unionByName(rows.where(wordless)).drop(key)
