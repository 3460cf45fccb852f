"""The streaming daily rollup emits exactly the batch rows for every finalised day."""

import os

from pyspark.sql import functions as F

from ledgerlens.operators import prepare as PR
from ledgerlens.operators import rollups as R
from ledgerlens.plans.context import context
from ledgerlens.streaming.daily_stream import start_daily_stream


def test_stream_matches_batch_for_final_days(spark, sf_small, tmp_out):
    ctx = context(spark, sf_small)
    b = ctx.bookings.drop("is_partial")
    schema = b.schema
    inp = os.path.join(tmp_out, "in")
    years = [r[0] for r in b.select(F.year("collection_date")).distinct().orderBy(1).collect()]
    first, rest = years[: len(years) // 2], years[len(years) // 2:]
    b.filter(F.year("collection_date").isin(first)).write.parquet(os.path.join(inp, "extract_a"))
    tp = ctx.top("package_code", 15)
    tc = ctx.top("city", 6)
    out, ck = os.path.join(tmp_out, "out"), os.path.join(tmp_out, "ck")
    start_daily_stream(spark, inp + "/*", schema, tp, tc, out, ck).awaitTermination(300)
    b.filter(F.year("collection_date").isin(rest)).write.parquet(os.path.join(inp, "extract_b"))
    start_daily_stream(spark, inp + "/*", schema, tp, tc, out, ck).awaitTermination(300)

    got = spark.read.parquet(out)
    assert got.count() > 0
    settled = PR.settled_rows(b)
    src = PR.bucket_by_top(PR.bucket_by_top(settled, tp, "package_code", "package_bucket"), tc, "city", "city_bucket")
    batch = R.summary(src, ["booking_date", "package_bucket", "city_bucket"])
    cols = ["booking_date", "package_bucket", "city_bucket", "bookings", "gm_sum", "revenue_sum"]
    # every emitted day equals the batch answer; no emitted row is missing or different
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    emitted_days = got.select("booking_date").distinct()
    assert batch.join(emitted_days, "booking_date").select(cols).exceptAll(got.select(cols)).count() == 0


def test_late_rows_count_and_are_kept_aside(spark, sf_small, tmp_out):
    """Files in three batches, the last with rows of days long published: every day equals the
    batch answer, the late rows stand in the side table, and a replayed batch changes nothing."""
    from ledgerlens.streaming.daily_stream import refresh_days, start_daily_refresh
    ctx = context(spark, sf_small)
    b = ctx.bookings.drop("is_partial")
    inp, out, ck = (os.path.join(tmp_out, x) for x in ("in", "out", "ck"))
    late = (F.col("booking_id") % 7 == 0) & (F.year("booking_date") <= 1997)
    parts = [b.where(~late & (F.year("booking_date") <= 1996)), b.where(~late & (F.year("booking_date") > 1996)),
             b.where(late).unionByName(b.where(late).limit(2).withColumn("booking_date", F.lit(None).cast("date")))]
    tp, tc = ctx.top("package_code", 15), ctx.top("city", 6)
    cols = ["booking_date", "package_bucket", "city_bucket", "bookings", "gm_sum", "revenue_sum", "gm_pct"]
    arrived = None
    for k, part in enumerate(parts):
        part.write.parquet(os.path.join(inp, f"extract_{k}"))
        arrived = part if arrived is None else arrived.unionByName(part)
        start_daily_refresh(spark, inp + "/*", b.schema, tp, tc, out, ck).awaitTermination(300)
        src = PR.settled_rows(arrived).where("booking_date is not null")
        src = PR.bucket_by_top(PR.bucket_by_top(src, tp, "package_code", "package_bucket"), tc, "city", "city_bucket")
        want = R.summary(src, ["booking_date", "package_bucket", "city_bucket"]).select(cols)
        got = spark.read.parquet(f"{out}/daily").select(cols)
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    aside = spark.read.parquet(f"{out}/late")
    settled_late = PR.settled_rows(parts[2]).select("booking_id", "booking_date")
    assert aside.select("booking_id", "booking_date").exceptAll(settled_late).count() == 0
    n = aside.count()
    assert n == settled_late.count() > 100 and {r[0] for r in aside.select("batch").distinct().collect()} == {2}
    before = spark.read.parquet(f"{out}/daily").select(cols).collect()
    refresh_days(spark.read.schema(b.schema).parquet(os.path.join(inp, "extract_2")), 2, tp, tc, out)
    assert sorted(spark.read.parquet(f"{out}/daily").select(cols).collect()) == sorted(before)
    assert spark.read.parquet(f"{out}/late").count() == n
