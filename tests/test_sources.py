"""Sources and sinks: template CSV, multi-file extracts, JSON params, writes."""

import json
import os

from pyspark.sql import functions as F

from ledgerlens.operators import rollups as R
from ledgerlens.sources import files as S

TEMPLATE = """booking_date,market,sku,tier,channel,flag,coupon,offer_price,campaign_discount,member_discount,coupon_discount,wallet_credit,gift_card,net_revenue,cost
2031-03-04,N1,ITEM-7,Basic,Self,Fresh,TRY5,40,0,0,2,0,0,38,11.5
2031-03-05,N2,ITEM-3,Plus,Sales,Repeat,TRY10,60.5,0,6.05,6.05,0,0,48.4,20.25
2031-03-06,N1,ITEM-9,Plus,Phlebo,Repeat,,18.75,0,1.25,0,0,0,17.5,4.5
"""


def test_template_roundtrip_and_waterfall(spark, tmp_out):
    p = os.path.join(tmp_out, "template.csv")
    with open(p, "w") as f:
        f.write(TEMPLATE)
    df = S.read_template_bookings(spark, p)
    assert df.filter(F.col("coupon").isNull()).count() == 1
    fact = S.template_to_fact(df).withColumn("is_partial", F.lit(False))
    wf = R.weekly_waterfall(fact).first()
    assert wf["offer_sum"] == 4000 + 6050 + 1875
    assert wf["net_sum"] - wf["cpt_sum"] == wf["gm_sum"]
    assert wf["offer_sum"] - wf["vip_sum"] - wf["coupon_sum"] == wf["net_sum"]


def test_multi_file_scan_tags_file(spark, tmp_out):
    for m in ("07", "08"):
        spark.createDataFrame([(int(m), f"2026-{m}-01")], "booking_id long, d string").write.mode(
            "overwrite").parquet(os.path.join(tmp_out, f"raw_{m}"))
    df = S.read_extracts(spark, os.path.join(tmp_out, "raw_*"))
    files = {r["booking_id"]: r["_src_file"] for r in df.collect()}
    assert len(files) == 2 and all(v.endswith(".parquet") for v in files.values())


def test_manifest_json(spark, tmp_out):
    p = os.path.join(tmp_out, "manifest.json")
    doc = {"files": [{"filename": "part-1.xlsx", "rows": 3, "collection_date_min": "2031-03-02",
                      "collection_date_max": "2031-03-28", "collection_months": ["2031-03"],
                      "booking_date_min": "2031-02-11", "booking_date_max": "2031-03-30",
                      "booking_id_min": 1, "booking_id_max": 9}]}
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    files = S.manifest_files(spark, p).collect()
    assert files[0]["rows"] == 3 and files[0]["collection_months"] == ["2031-03"]


def test_write_tables_and_persist(spark, tmp_out, sf_small):
    import __spark_entry__ as E
    wf = E.queries()["weekly_waterfall"](spark, sf_small)
    paths = S.write_tables({"weekly_waterfall": wf}, tmp_out, fmt="csv")
    back = spark.read.option("header", True).csv(paths["weekly_waterfall"])
    assert back.count() == wf.count()
    from ledgerlens.plans.context import context
    out = S.persist_prepared(context(spark, sf_small).bookings, os.path.join(tmp_out, "prepared"))
    pruned = spark.read.parquet(out).filter(F.col("booking_month") == "1996-01")
    assert pruned.count() > 0
    assert "PartitionFilters" in pruned._jdf.queryExecution().executedPlan().toString()


def test_refresh_from_extracts(spark, sf_small, tmp_out):
    """Extracts with untidy headers and keys, NaN margins and unreadable cost become the ten tables."""
    import pytest
    from ledgerlens.plans.context import context
    from ledgerlens.plans.refresh import extracts_fact, refresh_from_extracts
    ctx = context(spark, sf_small)
    single = ctx.bookings.groupBy("booking_id").count().where("count = 1").select("booking_id")
    raw = ctx.bookings.drop("is_partial", "week_start", "cpt_c").join(single, "booking_id", "left_semi")
    raw = raw.withColumn("gm_c", F.coalesce(F.col("gm_c").cast("double"), F.lit(float("nan"))))
    for year in (0, 1):
        raw.where((F.year("collection_date") % 2) == year).withColumn(
            "coupon_code", F.coalesce(F.concat(F.col("coupon_code"), F.lit(" ")), F.lit("  "))).write.parquet(
            os.path.join(tmp_out, f"extract_{year}"))
    pattern = os.path.join(tmp_out, "extract_*")
    fact = extracts_fact(spark, pattern)
    assert fact.where("gm_c is not null and cpt_c != net_c - gm_c").count() == 0
    assert fact.where("coupon_code = ''").count() == 0 and fact.where("coupon_code is null").count() > 0
    paths = refresh_from_extracts(spark, pattern, os.path.join(tmp_out, "published"))
    assert len(paths) == 10
    wf = spark.read.parquet(paths["weekly_waterfall"]).agg(F.sum("bookings").alias("n"), F.sum("gm_sum").alias("g")).first()
    want = (ctx.clean.join(single, "booking_id", "left_semi")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("gm_c").alias("g")).first())
    assert (wf["n"], wf["g"]) == (want["n"], want["g"])
    raw.limit(5).withColumn("coupon_code", F.col("coupon_code")).write.parquet(os.path.join(tmp_out, "extract_9"))
    with pytest.raises(AssertionError, match="not unique"):
        refresh_from_extracts(spark, pattern, os.path.join(tmp_out, "again"))


def test_refresh_writes_ten_tables(spark, sf_small, tmp_out):
    from ledgerlens.plans.refresh import model_tables, refresh_rollups
    paths = refresh_rollups(spark, sf_small, tmp_out)
    assert len(paths) == 10
    assert spark.read.parquet(paths["weekly_waterfall"]).count() > 0
    assert set(model_tables(spark, sf_small)) >= {"campaign_scorecard", "stacking_risk"}


def test_persist_prepared_one_slice_per_task(spark, tmp_out, sf_small):
    """Range-partitioned write: each task writes a contiguous date slice, so the file count
    stays near the task count instead of tasks x months, and the rows are the same multiset
    (ids repeat in the driver data, so no uniqueness is assumed)."""
    import glob
    from ledgerlens.plans.context import context
    fact = context(spark, sf_small).bookings
    out = S.persist_prepared(fact, os.path.join(tmp_out, "prepared_rng"))
    files = glob.glob(os.path.join(out, "booking_month=*", "*.parquet"))
    months = glob.glob(os.path.join(out, "booking_month=*"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= tasks + len(months)
    back = spark.read.parquet(out)
    assert back.count() == fact.count()
    cols = ["booking_id", "booking_date", "offer_c", "gm_c"]
    assert back.select(*cols).exceptAll(fact.select(*cols)).count() == 0
    assert fact.select(*cols).exceptAll(back.select(*cols)).count() == 0


BROKEN = TEMPLATE + """soon,N1,ITEM-7,Basic,Self,Fresh,TRY5,40,0,0,2,0,0,38,11.5
2031-03-07,N1,ITEM-7,Basic,Self,Fresh,TRY5,forty,0,0,2,0,0,38,11.5
2031-03-08,N1,ITEM-7,Basic,Self
2031-03-09,N1,ITEM-7,Basic,Self,Fresh,TRY5,40,0,0,2,0,0,38,11.5,one,too,many
"""


def test_unreadable_rows_are_set_aside_and_counted(spark, tmp_out):
    import pytest
    for name, text in (("a", BROKEN), ("b", TEMPLATE)):
        with open(os.path.join(tmp_out, f"{name}.csv"), "w") as f:
            f.write(text)
    paths = [os.path.join(tmp_out, f"{n}.csv") for n in "ab"]
    bad = os.path.join(tmp_out, "bad")
    got = S.read_template_checked(spark, paths, bad, most=0.5)
    assert got.count() == 6 and got.select("market").count() == 6 and got.where("offer_price is null").count() == 0
    assert got.agg(F.sum("net_revenue")).first()[0] == 2 * S.read_template_bookings(spark, paths[1]).agg(F.sum("net_revenue")).first()[0]
    lines = {(os.path.basename(r.file), r.line) for r in spark.read.parquet(bad).collect()}
    assert lines == {("a.csv", x) for x in BROKEN.splitlines()[4:]}
    with pytest.raises(ValueError, match="4 of 10 rows are unreadable"):
        S.read_template_checked(spark, paths, os.path.join(tmp_out, "again"))
    assert spark.read.parquet(os.path.join(tmp_out, "again")).count() == 4      # kept although refused
    assert S.read_template_checked(spark, paths[1], os.path.join(tmp_out, "none")).count() == 3
    assert spark.read.parquet(os.path.join(tmp_out, "none")).count() == 0
