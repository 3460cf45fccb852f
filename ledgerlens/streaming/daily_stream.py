"""Incremental daily rollup with Structured Streaming.

Extracts land as files (one per collection month); a booking can arrive up to the
settlement lag after its booking date. The stream reads new files, keeps settled rows,
buckets long-tail packages and cities by a static top list (stream-static broadcast join,
at most N rows), and aggregates per day with a watermark on the booking time: a day is
emitted once, in append mode, when the watermark passes its end, so the Parquet sink only
ever receives final rows. State for open days lives in the checkpoint folder, so a
restarted query (or a lost executor) resumes where it stopped.

Rows later than the watermark are dropped by that query. ``start_daily_refresh`` is the one that
loses none: every micro-batch adds its own sums to the days it touches and publishes these days
anew, and rows that come later than the lag are also kept aside with their count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import params as P
from ..functions import exprs as X
from ..operators.prepare import bucket_by_top, settled_rows
from ..session import exists

SETTLEMENT_LAG = "45 days"


def daily_stream(spark: SparkSession, input_glob: str, schema: T.StructType, top_packages: DataFrame,
                 top_cities: DataFrame, lag: str = SETTLEMENT_LAG) -> DataFrame:
    """Streaming DataFrame of final daily rows (booking_day, package_bucket, city_bucket)."""
    src = spark.readStream.schema(schema).parquet(input_glob)
    rows = (src.filter(F.col("gm_c").isNotNull())
            .withColumn("event_ts", F.col("booking_date").cast("timestamp"))
            .withWatermark("event_ts", lag))
    tp = F.broadcast(top_packages.select(F.col("package_code").alias("_pk")))
    tc = F.broadcast(top_cities.select(F.col("city").alias("_ct")))
    rows = (rows.join(tp, rows.package_code == tp._pk, "left").join(tc, rows.city == tc._ct, "left")
            .withColumn("package_bucket", F.coalesce("_pk", F.lit(P.OTHER)))
            .withColumn("city_bucket", F.coalesce("_ct", F.lit(P.OTHER))))
    # Group on the event-time column itself (midnight of the booking day): no epoch-aligned
    # window, so the day is the same in every session time zone; date -> timestamp -> date
    # is exact.
    agg = rows.groupBy("event_ts", "package_bucket", "city_bucket").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"))
    return agg.select(F.col("event_ts").cast("date").alias("booking_date"), "package_bucket", "city_bucket",
                      "bookings", "gm_sum", "revenue_sum", X.ratio_pct("gm_sum", "revenue_sum").alias("gm_pct"))


def start_daily_stream(spark: SparkSession, input_glob: str, schema: T.StructType, top_packages: DataFrame,
                       top_cities: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                       lag: str = SETTLEMENT_LAG) -> StreamingQuery:
    """Start the stream into a Parquet sink (append: each day is written once, final)."""
    q = (daily_stream(spark, input_glob, schema, top_packages, top_cities, lag)
         .writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


DAILY = ["booking_date", "package_bucket", "city_bucket"]
#: Days after the newest published day's booking within which a row counts as in time.
LAG_DAYS = 45


def refresh_days(batch: DataFrame, batch_id: int, top_packages: DataFrame, top_cities: DataFrame, out_path: str,
                 lag_days: int = LAG_DAYS) -> None:
    """Bring the days of one micro-batch up to date. Under ``out_path``: ``parts`` holds the sums of
    each (day, batch), ``daily`` the published days (both in folders by month; the months that a batch
    touches are published anew), ``late`` the rows that
    came more than ``lag_days`` after the newest day published before, or have no date. A batch that
    is replayed overwrites what it wrote."""
    spark = batch.sparkSession
    parts, daily = f"{out_path}/parts", f"{out_path}/daily"
    rows = settled_rows(batch).withColumn("batch", F.lit(batch_id))
    newest = None
    if exists(spark, daily):  # other batches only: a replay must not see its own days
        newest = spark.read.parquet(parts).where(F.col("batch") != batch_id).agg(F.max("booking_date")).first()[0]
    late = F.col("booking_date").isNull()
    if newest is not None:
        late = late | (F.col("booking_date") < F.date_sub(F.lit(newest), lag_days))
    rows.where(late).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out_path}/late")
    dated = rows.where("booking_date is not null")
    both = bucket_by_top(bucket_by_top(dated, top_packages, "package_code", "package_bucket"), top_cities, "city", "city_bucket")
    sums = both.groupBy(*DAILY, "batch").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"),
                                             X.sum0("net_c").alias("revenue_sum"))
    month = F.date_format("booking_date", "yyyyMM").cast("int").alias("month")
    # a month's sums stand in one task, so one file a month and batch
    (sums.select("*", month).repartition("month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch").parquet(parts))
    kept = spark.read.parquet(parts)
    touched = [r.month for r in kept.where(F.col("batch") == batch_id).select("month").distinct().collect()]
    if not touched:  # their number is bounded by the calendar
        return
    total = kept.where(F.col("month").isin(touched)).groupBy("month", *DAILY).agg(
        *[F.sum(c).alias(c) for c in ("bookings", "gm_sum", "revenue_sum")])
    (total.withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum")).repartition("month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(daily))


def start_daily_refresh(spark: SparkSession, input_glob: str, schema: T.StructType, top_packages: DataFrame,
                        top_cities: DataFrame, out_path: str, checkpoint: str, available_now: bool = True,
                        lag_days: int = LAG_DAYS) -> StreamingQuery:
    """The daily rollup without a watermark: days stay open, late rows count and are kept aside."""
    q = (spark.readStream.schema(schema).parquet(input_glob).writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, k: refresh_days(batch, k, top_packages, top_cities, out_path, lag_days)))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
