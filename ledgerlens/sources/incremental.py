"""The prepared fact kept up to date month by month.

Beside the fact, ``_files`` holds one row for each extract file it was made from: path, length,
time, rows and the booking months in it. A refresh lists the files (their content is not read),
compares them with that table, reads the new and changed files once for their months, and rewrites
only the months which a new, changed or removed file has rows in: from all files that have such
rows, by dynamic partition overwrite. The file table is replaced last, so an interrupted refresh is
simply done again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import exists, folder_of

FILES = "path string, length long, modified timestamp, rows long, months array<string>"
MONTH = "booking_month"
#: Month of rows without a booking date.
NO_MONTH = "none"


def listed_files(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length and time of every file that matches, or lies in a folder that does."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def month_of(date: str = "booking_date"):
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


def _state(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/_files"
    if not exists(spark, path + "/_SUCCESS"):
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).parquet(path)


def refresh_months(spark: SparkSession, pattern: str, folder: str,
                   prepare: Callable[[SparkSession, list[str]], DataFrame]) -> list[str]:
    """Bring the prepared fact in ``folder`` up to date with the files that match; the months that
    were rewritten. ``prepare(spark, paths)`` gives the rows of files, with their ``_src_path``."""
    folder = folder.rstrip("/")
    old = {r.path: r for r in _state(spark, folder).collect()}              # one row a file
    now = {r.path: r for r in listed_files(spark, pattern).collect()}
    fresh = [p for p, r in now.items() if p not in old or (old[p].length, old[p].modified) != (r.length, r.modified)]
    gone = [p for p in old if p not in now]
    if not fresh and not gone:
        return []
    profile = {}
    if fresh:
        rows = prepare(spark, sorted(fresh)).groupBy("_src_path").agg(
            F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_set(month_of())).alias("months"))
        profile = {r._src_path: (r["rows"], list(r.months)) for r in rows.collect()}
    kept = {p: (r.rows, list(r.months)) for p, r in old.items() if p in now and p not in fresh}
    months = sorted({m for _, found in profile.values() for m in found} | {
        m for p in [*gone, *(f for f in fresh if f in old)] for m in old[p].months})
    every = {**kept, **{p: profile.get(p, (0, [])) for p in fresh}}
    touched = sorted(p for p, (_, found) in every.items() if set(found) & set(months))
    fs, path = folder_of(spark, folder)
    if touched:
        rows = prepare(spark, touched).drop("_src_path").withColumn(MONTH, month_of()).where(F.col(MONTH).isin(months))
        (rows.repartitionByRange("booking_date", "booking_id").sortWithinPartitions("booking_date", "booking_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(folder))
    filled = {m for p in touched for m in every[p][1]}
    for month in set(months) - filled:  # the last rows of the month are gone
        fs.delete(path(f"{folder}/{MONTH}={month}"), True)
    state = [(p, now[p].length, now[p].modified, n, found) for p, (n, found) in sorted(every.items())]
    made = f"{folder}/_files-{uuid.uuid4().hex}"
    spark.createDataFrame(state, FILES).coalesce(1).write.parquet(made)
    fs.delete(path(f"{folder}/_files"), True)
    if not fs.rename(path(made), path(f"{folder}/_files")):
        raise RuntimeError(f"the file table could not be put in {folder}")
    return months


def read_prepared(spark: SparkSession, folder: str) -> DataFrame:
    """The prepared fact; ``booking_month`` prunes its folders."""
    return spark.read.option("basePath", folder).parquet(folder)
