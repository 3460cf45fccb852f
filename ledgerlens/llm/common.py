"""Shared pieces of the training-data operators: row mapping over Arrow batches, word
splitting on raw UTF-8 bytes, vectorised hashing, and tables written to the shared folder."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

#: Rows per Arrow batch sent to Python: bounds worker memory when texts are very long.
ROWS_PER_BATCH = 1000

_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Byte table: lower-cases A-Z, turns every byte outside [0-9a-z] and above 0x7F into a space.
#: UTF-8 continuation bytes are all above 0x7F, so characters are never cut.
ALNUM = bytes((b + 32) if 0x41 <= b <= 0x5A else (b if b in _KEPT else 0x20) for b in range(256))
#: Byte table: lower-cases A-Z only.
LOWER = bytes((b + 32) if 0x41 <= b <= 0x5A else b for b in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z lower-cased text; null has none."""
    return text.translate(ALNUM).split() if text else []


def space_words(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (what ``bytes.split`` cuts at); null has none."""
    if not text:
        return []
    return (text.translate(LOWER) if lower else text).split()


class HashMemo(dict):
    """word -> 64-bit hash, remembered for at most ``limit`` words per worker."""

    def __init__(self, limit: int = 1 << 19, seed: int = 0):
        super().__init__()
        self.limit, self.seed = limit, seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return h


_memos: dict[int, HashMemo] = {}


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    memo = _memos.setdefault(seed, HashMemo(seed=seed))
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer over uint64 (wraps), so that any bits of the result may be used."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class WindowHash:
    """Polynomial hashes modulo 2^64 of every window of consecutive symbols (an odd base can be
    inverted, so a prefix sum gives all windows of one length in a few array operations)."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            up, down = np.full(size, self.base, np.uint64), np.full(size, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        self._powers(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * self.up[:n], out=out[1:])
        return out

    def windows(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """Hash of symbols[s : s + length] for every start s."""
        n = len(prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix64((prefix[length:] - prefix[:n]) * self.down[:n])

    def spans(self, prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of symbols[lo : hi] for arrays of bounds; the length is mixed in."""
        return mix64((prefix[hi] - prefix[lo]) * self.down[lo] + mix64((hi - lo).astype(np.uint64)))


#: Two independent families; fixed odd bases of this library.
WIDE = (WindowHash(0x9E6C63D0876A3F6B), WindowHash(0xD6E8FEB86659FD93))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:len(out) - step], out[step:])
        have += step
    return out


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Boolean mask of the positions below n inside any [start, start + length)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + lengths, n), -1)
    return np.cumsum(edge[:n]) > 0


def mask_runs(mask: np.ndarray) -> int:
    """Number of maximal runs of True."""
    return int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application, as ``--py-files`` would,
    so that a job also runs where only the driver can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    if package.is_dir():  # else it already came as an archive
        target = Path(tempfile.mkdtemp(prefix="ledgerlens-py-")) / "ledgerlens.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


def batched(df: DataFrame, fn: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with bounded batches; ``fn`` takes and yields record batches."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return df.mapInArrow(fn, schema)


def per_document(docs: DataFrame, schema: str, make: Callable[[], Callable], keep: bool = False,
                 more: str | None = None) -> DataFrame:
    """One output row for each input row: doc_id (or, with ``keep``, every input column) and
    the columns of ``schema``, which ``make()(texts)`` returns as a list of Arrow arrays. The
    values of the column ``more`` are its second argument and not put out.

    An input column named like an output column, in any case, gives way to the operator's column."""
    new = T.StructType.fromDDL(schema)
    names = new.fieldNames()
    old = [f for f in remaining(docs, names) if f.name != more and (keep or f.name.lower() == "doc_id")]
    kept = [f.name for f in old]
    extra = [more] if more else []
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, "text", *extra])])

    def run(batches):
        score = make()
        for batch in batches:
            columns = [batch.column(c) for c in kept] + score(texts_of(batch), *[batch.column(c).to_pylist() for c in extra])
            yield pa.RecordBatch.from_arrays(columns, names=kept + names)

    return batched(source, run, T.StructType(old + new.fields))


def remaining(docs: DataFrame, names: list[str]) -> list[T.StructField]:
    """Fields of ``docs`` not named like one of ``names``; Spark's names have no case."""
    taken = {n.lower() for n in names}
    return [f for f in docs.schema.fields if f.name.lower() not in taken]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it a name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def signed(values: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


#: Tables made inside the innermost ``scratch`` block, for each open block.
_scopes: list[list[DataFrame]] = []


@contextlib.contextmanager
def scratch():
    """Tables that ``written`` makes inside the block are deleted at its end, but for those written
    with ``stays``: the block must have used up what reads the others."""
    _scopes.append([])
    try:
        yield
    finally:
        for made in _scopes.pop():
            discard(made)


def written(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage in a way that
    survives lost executors, and computes ``df`` once for several readers. Inside a ``scratch``
    block the table is deleted at the end of the block, with ``stays`` at that of the next outer one."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    # shuffle files of the finished job are removed when the driver's JVM collects what held them
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    scopes = _scopes[:-1] if stays else _scopes
    if scopes:
        scopes[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    path = df.written_to
    sc = df.sparkSession.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
