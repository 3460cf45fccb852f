"""Operator 9: approximate nearest neighbours by an adaptive dimension scan.

Index: k-means centres are fitted to a bounded sample; every vector is rotated by one random
orthogonal matrix and stored in the list of its nearest centre. Search: each query probes its
nearest lists. Inside a list a block of candidates is scanned by blocks of rotated dimensions:
after d of D dimensions the squared distance is estimated by D / d times the partial one, and a
candidate whose estimate exceeds the query's tenth best distance by more than the hypothesis
test allows is abandoned; survivors get their exact distance on the original vectors.

Equal vectors are one candidate with its smallest ids (only these can be among the nearest, ties
going to the smaller id) and one query, so a vector that a third of all rows share costs one.
Lists are cut into blocks of bounded size, each scanned on its own; the best of all blocks of a
query are merged by a window.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
neither as queries nor as candidates; so does a null vec_id. Vectors of different lengths have no
distance: each length is searched on its own. A vec_id that occurs in several rows is several
candidates, of which a query leaves out one equal to itself; equal rows are one query, rows of one
vec_id with different vectors are several. With fewer than k candidates all are returned; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batched, written

#: Vectors, by smallest hash, that k-means is fitted to, and rounds of fitting.
SAMPLE_ROWS = 20_000
ROUNDS = 12
#: Centres: twice the square root of the sample, within bounds.
LEAST_LISTS, MOST_LISTS = 8, 1024
#: Share of all lists that a query probes, and at least so many. Vectors without clusters need
#: a large share (a quarter reaches recall 0.75 on the test vectors, this 0.96 or more).
PROBE_SHARE, LEAST_PROBES = 0.65, 8
#: Candidates scanned together.
BLOCK = 4096
#: Rotated dimensions of a column block, and the significance of the hypothesis test.
STEP = 16
EPSILON = 2.1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
            & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists("v", lambda x: x != 0))
    return vectors.select("vec_id", "embedding", v.alias("v")).where(fine).select("vec_id", "v")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """One row for each distinct vector: key (its hash), v and its k + 1 smallest ids."""
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 becomes 0.0
    few = W.partitionBy("v").orderBy("vec_id")
    return (rows.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1)
            .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select(F.xxhash64("v").alias("key"), "v", "ids"))


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Centres by k-means on the sample, and a random orthogonal matrix."""
    sample = np.array([r.v for r in rows.orderBy("key", "v").select("v").limit(SAMPLE_ROWS).collect()], float)
    rng = np.random.default_rng(7)
    lists = int(np.clip(2 * np.sqrt(len(sample)), LEAST_LISTS, MOST_LISTS))
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        near = nearest_lists(sample, centres, 1)[:, 0]
        total, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(total, near, sample)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    rotation, _ = np.linalg.qr(rng.standard_normal((sample.shape[1], sample.shape[1])))
    return centres, rotation


def nearest_lists(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    d = (centres ** 2).sum(1) - 2 * x @ centres.T
    n = min(n, len(centres))
    return np.argpartition(d, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(np.arange(n), (len(x), 1))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def assigned(rows: DataFrame, shared, probes: int, name: str) -> DataFrame:
    """Rows with the number of their nearest list, or of each list to probe."""
    def run(batches):
        centres = shared.value[0]
        for batch in batches:
            near = nearest_lists(matrix(batch.column("v")), centres, probes)
            row = pa.array(np.repeat(np.arange(len(near)), near.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(row) for c in ("key", "v", "ids")] + [
                pa.array(near.ravel(), pa.int32())], names=["key", "v", "ids", "list"])

    return batched(rows.select("key", "v", "ids"), run, f"key long, v array<double>, ids array<{name}>, list int")


def scan(queries: np.ndarray, block: np.ndarray, rotation: np.ndarray, k: int):
    """For each query the candidates of the block that may be among its k nearest."""
    q, c = queries @ rotation, np.ascontiguousarray((block @ rotation).T)  # candidates by columns
    dims = c.shape[0]
    for i in range(len(q)):
        first = ((queries[i] - block[:2 * k + 2]) ** 2).sum(1)  # exact distances to start with
        best = np.partition(first, k)[k] if len(first) > k else np.inf
        alive, part = np.arange(c.shape[1]), np.zeros(c.shape[1])
        for d in range(0, dims, STEP):
            end = min(d + STEP, dims)
            part = part + ((c[d:end, alive] - q[i, d:end, None]) ** 2).sum(0)
            if end < dims and np.isfinite(best):
                going = part * (dims / end) <= best * (1 + EPSILON / np.sqrt(end)) ** 2
                alive, part = alive[going], part[going]
            if end < dims and len(alive) > 4 * k:
                few = alive[np.argpartition(part, k)[:k + 1]]  # likely best: their exact distances tighten the test
                best = min(best, ((queries[i] - block[few]) ** 2).sum(1).max())
        exact = np.sqrt(((queries[i] - block[alive]) ** 2).sum(1))
        if len(alive) > k:
            bound = np.partition(exact, k)[k]
            alive, exact = alive[exact <= bound], exact[exact <= bound]
        yield i, alive, exact


def search(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest other rows of each row whose vec_id is divisible by ``every``."""
    name = vectors.schema["vec_id"].dataType.simpleString()
    rows = usable(vectors)
    lengths = sorted(r.d for r in rows.select(F.size("v").alias("d")).distinct().collect())  # one, as a rule
    out = None
    for d in lengths:
        found = search_length(rows.where(F.size("v") == d), name, every, k)
        out = found if out is None else out.union(found)
    return out or vectors.sparkSession.createDataFrame([], f"query_id {name}, rank int, vec_id {name}, score double")


def search_length(base: DataFrame, name: str, every: int, k: int) -> DataFrame:
    """``search`` over vectors of one length."""
    spark = base.sparkSession
    distinct = written(distinct_vectors(base, k), "vectors")
    centres, rotation = fit(distinct)
    shared = spark.sparkContext.broadcast((centres, rotation))  # at most MOST_LISTS centres
    probes = max(LEAST_PROBES, int(np.ceil(PROBE_SHARE * len(centres))))

    ids = base.where(F.col("vec_id") % every == 0).select("vec_id", F.transform(
        "v", lambda x: x + F.lit(0.0)).alias("v")).distinct()
    asked = ids.select("v").distinct().select(F.xxhash64("v").alias("key"), "v", F.array().cast(
        f"array<{name}>").alias("ids"))
    index = written(assigned(distinct, shared, 1, name), "index")
    sizes = index.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = (index.join(F.broadcast(sizes), "list")  # one row for each list
           .withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.col("blocks")).cast("int")))
    probe = (assigned(asked, shared, probes, name).join(F.broadcast(sizes), "list")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"key": pd.Series(dtype="int64"), "near": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object),
                             "score": pd.Series(dtype=float)})]
        if len(left) and len(right):
            block, queries = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
            for i, alive, exact in scan(queries, block, shared.value[1], k):
                out.append(pd.DataFrame({"key": right["key"].iloc[i], "near": left["key"].to_numpy()[alive], "ids": left["ids"].to_numpy()[alive],
                                         "score": exact}))
        return pd.concat(out[1:]) if len(out) > 1 else out[0]

    found = cut.select("list", "block", "v", "key", "ids").groupBy("list", "block").cogroup(
        probe.select("list", "block", "v", "key").groupBy("list", "block")).applyInPandas(
        run, f"key long, near long, ids array<{name}>, score double")
    near = W.partitionBy("key").orderBy("score", "vec_id")
    # k + 1, since one of them may be the query itself
    top = (found.select("key", "near", "score", F.explode("ids").alias("vec_id"))
           .withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).drop("r"))
    answers = (ids.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("key"))
               .join(top, "key"))
    same = W.partitionBy("query_id", "key", "vec_id", "near").orderBy("score")
    answers = (answers.withColumn("n", F.row_number().over(same))
               .where("not (vec_id = query_id and near = key and n = 1)"))  # but for the query's own row
    order = W.partitionBy("query_id", "key").orderBy("score", "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
