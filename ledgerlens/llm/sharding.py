"""Operator 2: sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``RING`` positions. Every shard owns ``VNODES`` of them, each at the hash of (shard,
replica), so a node stays where it is whatever the number of shards; a row hashes to
a position and belongs to the first virtual node clockwise. Loads are bounded exactly: with N
rows a shard takes N // shards of them, the first N % shards one more, so counts are at most
one apart (law ``rows``). A full shard keeps the first rows of its arcs in ring order; the
others queue up and continue clockwise, and each virtual node they pass takes as many as its
shard still has room for.

Only DataFrame functions. Rows are never ranked in one task: they are numbered inside their
ring position, one with many rows (of one id, or of null ids with one text) in ``SALT`` parts by
the scan's partition, and everything else is arithmetic on ``SALT`` counters per position, a table
of ``RING`` rows whatever the input.

Defined results: null text has size 8 and the checksum of the empty text; a null doc_id hashes
by its text's checksum; repeated rows are rows of their own; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

RING = 1 << 16
VNODES = 256
#: Parts in which the rows of one position are numbered.
SALT = 16


def placed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    spot = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32")).otherwise(F.xxhash64("doc_id"))
    return rows.select("*", spot.alias("spot"), F.pmod(spot, F.lit(RING)).cast("int").alias("position"),
                       (F.spark_partition_id() % SALT).alias("part"))


def ring(spark, shards: int) -> DataFrame:
    """Each position's virtual node (numbered clockwise) and its shard; RING rows."""
    nodes = (spark.range(shards * VNODES)
             .select((F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("replica"))
             .select("shard", F.pmod(F.xxhash64(F.lit("node"), "shard", "replica"), F.lit(RING)).cast("int").alias("position"))
             .groupBy("position").agg(F.min("shard").alias("shard"))
             .withColumn("node", F.row_number().over(W.orderBy("position")) - 1))
    ahead = W.orderBy(F.desc("position")).rowsBetween(W.unboundedPreceding, W.currentRow)
    everywhere = W.partitionBy()
    first = F.min(F.when(F.col("node") == 0, F.col("shard"))).over(everywhere)
    return (spark.range(RING).select(F.col("id").cast("int").alias("position")).join(nodes, "position", "left")
            .select("position", F.last("shard", True).over(ahead).alias("shard"),
                    F.last("node", True).over(ahead).alias("node"), first.alias("first"))
            .select("position", F.coalesce("shard", "first").alias("shard"),
                    F.coalesce("node", F.lit(0)).alias("node")))


def counters(rows: DataFrame) -> DataFrame:
    """(position, n, before): its rows, and for each part the number of rows in the parts before it."""
    parts = rows.groupBy("position", "part").agg(F.count(F.lit(1)).alias("c"))
    return (parts.groupBy("position").agg(F.sum("c").alias("n"), F.collect_list(F.struct("part", "c")).alias("parts"))
            .select("position", "n", F.expr(f"""transform(sequence(0, {SALT - 1}), k ->
                aggregate(filter(parts, p -> p.part < k), 0L, (s, p) -> s + p.c))""").alias("before")))


def pieces(counts: DataFrame, shards: int) -> DataFrame:
    """Where the rows of each position go: position -> array of (from, until, shard, slot, overflowed), in
    which rows number ``from`` to ``until`` - 1 of the position get slots from ``slot`` on."""
    spark = counts.sparkSession
    by_shard, everywhere = W.partitionBy("shard"), W.partitionBy()
    upto = by_shard.orderBy("position").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("n").over(everywhere)
    own = (ring(spark, shards).join(counts.select("position", "n"), "position", "left").withColumn("n", F.coalesce("n", F.lit(0)))
           .withColumn("cap", F.floor(total / shards) + (F.col("shard") < total % shards).cast("long"))
           .withColumn("home", F.sum("n").over(by_shard))
           .withColumn("slot", F.coalesce(F.sum("n").over(upto), F.lit(0)))
           .withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("cap") - F.col("slot"))))
           .withColumn("over", F.col("n") - F.col("kept"))
           .withColumn("at", F.sum("over").over(W.orderBy("node", "position")) - F.col("over")))
    own = written(own, "ring")  # RING rows, read several times below

    # The queue walks the ring twice, so that every shard is passed once after the last arrival.
    steps = (own.groupBy("node", "shard").agg(F.sum("over").alias("arrive"))
             .agg(F.array_sort(F.collect_list(F.struct("node", "shard", "arrive"))).alias("round")))
    room = (own.groupBy("shard").agg(F.max(F.col("cap") - F.least("cap", "home")).alias("room"))
            .agg(F.array_sort(F.collect_list(F.struct("shard", "room"))).alias("rooms")))
    taken = steps.join(room, F.lit(True)).select(F.expr(f"""
        aggregate(
          concat(round, transform(round, x -> named_struct('node', x.node, 'shard', x.shard, 'arrive', 0L))),
          named_struct('served', 0L, 'waiting', 0L,
                       'room', transform(sequence(0, {shards - 1}), s ->
                          coalesce(filter(rooms, r -> r.shard = s)[0].room, 0L)),
                       'takes', cast(array() as array<struct<at: bigint, n: bigint, shard: int>>)),
          (s, x) -> transform(
            array(least(s.waiting + x.arrive, s.room[x.shard])),
            take -> named_struct(
              'served', s.served + take,
              'waiting', s.waiting + x.arrive - take,
              'room', if(take = 0, s.room, transform(s.room, (r, i) -> if(i = x.shard, r - take, r))),
              'takes', if(take = 0, s.takes,
                          array_append(s.takes, named_struct('at', s.served, 'n', take, 'shard', x.shard)))))[0],
          s -> s.takes) as takes"""))
    before = W.partitionBy("shard").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    filled = own.groupBy("shard").agg(F.max(F.least("cap", "home")).alias("filled"))
    takes = (taken.select(F.inline("takes")).join(filled, "shard")
             .withColumn("slot", F.col("filled") + F.coalesce(F.sum("n").over(before), F.lit(0))))

    # Cut the queue at the starts of positions and of takes; each stretch lies in one of both.
    here = F.struct("position", "kept", "at").alias("here")
    there = F.struct("shard", "slot", "at").alias("there")
    sources = own.where("over > 0").select(F.col("at").alias("cut"), here)
    line = sources.unionByName(takes.select(F.col("at").alias("cut"), there), allowMissingColumns=True)
    along = W.orderBy("cut")
    stretch = (line.groupBy("cut").agg(F.max("here").alias("here"), F.max("there").alias("there"))
               .select("cut", F.last("here", True).over(along).alias("here"),
                       F.last("there", True).over(along).alias("there"),
                       F.lead("cut", 1).over(along).alias("until")))
    moved = stretch.select(
        F.col("here.position").alias("position"),
        F.struct((F.col("here.kept") + F.col("cut") - F.col("here.at")).alias("from"),
                 (F.col("here.kept") + F.coalesce("until", F.lit(1 << 62)) - F.col("here.at")).alias("until"),
                 F.col("there.shard").alias("shard"),
                 (F.col("there.slot") + F.col("cut") - F.col("there.at")).alias("slot"),
                 F.lit(True).alias("overflowed")).alias("piece"))
    stay = own.where("kept > 0").select("position", F.struct(
        F.lit(0).cast("long").alias("from"), F.col("kept").alias("until"), "shard", "slot",
        F.lit(False).alias("overflowed")).alias("piece"))
    return stay.union(moved).groupBy("position").agg(F.collect_list("piece").alias("pieces"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    rows = written(placed(docs), "placed")  # one scan of the texts; a row's part stays what it was
    counts = written(counters(rows), "counters")  # at most RING rows
    inside = W.partitionBy("position", "part").orderBy("spot", "doc_id", "text_crc32", "size")
    numbered = rows.withColumn("k", (F.row_number().over(inside) - 1).cast("long"))
    where = pieces(counts, shards).join(counts.select("position", "before"), "position")
    piece = F.expr("filter(pieces, p -> k >= p.from and k < p.until)[0]")
    return (numbered.join(F.broadcast(where), "position")  # at most RING rows of SALT counters and few pieces
            .withColumn("k", F.col("k") + F.col("before")[F.col("part")]).withColumn("piece", piece)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("piece.shard").alias("shard"),
                    (F.col("piece.slot") + F.col("k") - F.col("piece.from")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("piece.overflowed").alias("overflowed")))
