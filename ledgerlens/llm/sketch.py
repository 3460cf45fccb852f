"""Count-min sketches of 64-bit keys: every task sketches its rows, the partial sketches merge
chunk by chunk in two levels, and what counting at least two leaves is a bitmap per row of the
sketch. Counts saturate at two, so a cell is two bits; a key whose cells are all set may occur
twice (an overestimate), a key with an unset cell surely does not."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched, mix64

#: Cells of each row of a sketch and its rows. The broadcast bitmap has DEPTH * WIDTH / 8 bytes.
WIDTH = 1 << 26
DEPTH = 2
#: Cells of a chunk; a merge group holds one chunk.
CHUNK = 1 << 16
#: Keys a task gathers before it emits a partial sketch.
FLUSH = 1 << 21
#: Groups of the first merge level for each chunk (each has an own Python call, so not too many).
SPREAD = 4


def cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    return mix64(keys + np.uint64(0xA24BAED4963EE407 * (row + 1) & (1 << 64) - 1)) & np.uint64(width - 1)


def _partial(keys: np.ndarray, width: int) -> pa.RecordBatch:
    """One row per chunk touched: offsets of its cells with a key, and of those with several."""
    rows, chunks, once, twice = [], [], [], []
    for row in range(DEPTH):
        cell, n = np.unique(cells(keys, row, width), return_counts=True)
        chunk = (cell // CHUNK).astype(np.int64)
        offset = (cell % CHUNK).astype(np.uint16)
        ends = np.flatnonzero(np.diff(chunk, append=-1)) + 1
        start = 0
        for end in ends.tolist():
            part = offset[start:end]
            rows.append(row)
            chunks.append(int(chunk[start]))
            once.append(part.tobytes())
            twice.append(part[n[start:end] > 1].tobytes())
            start = end
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(chunks, pa.int64()), pa.array(
        once, pa.binary()), pa.array(twice, pa.binary())], names=["row", "chunk", "once", "twice"])


def repeated_bitmap(df: DataFrame, keys_of: Callable[[pa.RecordBatch], list[np.ndarray]],
                    width: int | None = None) -> np.ndarray:
    """Bitmap (DEPTH x width / 8 bytes) of the cells that count two keys or more. ``keys_of``
    gives the uint64 keys of each row of a batch; a key counts once for each row it is in."""
    width = width or WIDTH

    def sketch(batches):
        held, size = [], 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
            if size >= FLUSH:
                yield _partial(np.concatenate(held), width)
                held, size = [], 0
        if size:
            yield _partial(np.concatenate(held), width)

    def merged(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        once, twice = np.zeros(CHUNK, bool), np.zeros(CHUNK, bool)
        for a, b in zip(pdf["once"], pdf["twice"]):
            a = np.frombuffer(a, np.uint16)
            twice[a[once[a]]] = True
            once[a] = True
            twice[np.frombuffer(b, np.uint16)] = True
        return once, twice

    def first(pdf: pd.DataFrame) -> pd.DataFrame:
        once, twice = merged(pdf)
        return pd.DataFrame({"row": [pdf["row"].iloc[0]], "chunk": [pdf["chunk"].iloc[0]],
                             "once": [np.flatnonzero(once).astype(np.uint16).tobytes()],
                             "twice": [np.flatnonzero(twice).astype(np.uint16).tobytes()]})

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": [pdf["row"].iloc[0]], "chunk": [pdf["chunk"].iloc[0]],
                             "bits": [np.packbits(merged(pdf)[1], bitorder="little").tobytes()]})

    parts = batched(df, sketch, "row int, chunk long, once binary, twice binary").withColumn(
        "salt", F.spark_partition_id() % SPREAD)
    # one exchange for both levels, with a stated number of parts: the rows are few bytes but much work
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(n, "row", "chunk")
    level = parts.groupBy("row", "chunk", "salt").applyInPandas(first, "row int, chunk long, once binary, twice binary")
    bits = level.groupBy("row", "chunk").applyInPandas(last, "row int, chunk long, bits binary")
    out = np.zeros((DEPTH, width // CHUNK, CHUNK // 8), np.uint8)
    for r in bits.toLocalIterator():  # at most DEPTH * WIDTH / 8 bytes
        out[r.row, r.chunk] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.reshape(DEPTH, -1)


def maybe_repeated(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Mask of the keys that the sketch counts at least twice."""
    out = np.ones(len(keys), bool)
    for row in range(len(bitmap)):
        cell = cells(keys, row, bitmap.shape[1] * 8)
        out &= (bitmap[row][(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8) & 1) > 0
    return out
