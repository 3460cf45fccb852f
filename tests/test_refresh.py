"""Incremental refresh, one-pass tables and their checks."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import prepare as PR
from ledgerlens.plans import one_pass
from ledgerlens.plans.context import context
from ledgerlens.plans.refresh import extracts_fact, refresh_from_extracts, refresh_rollups, rollup_tables
from ledgerlens.sources.incremental import read_prepared, refresh_months


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_tables_equal_the_rollups(spark, sf_small, tmp_out):
    ctx = context(spark, sf_small)
    paths = refresh_rollups(spark, sf_small, tmp_out)
    want = rollup_tables(ctx)
    assert set(paths) == set(want) and len(paths) == 10
    for name, df in want.items():
        got = spark.read.parquet(paths[name])
        assert got.dtypes == df.dtypes and same(got, df), name
    assert not glob.glob(os.path.join(tmp_out, "_staging*"))


def test_two_scans_of_the_fact(spark, sf_small):
    ctx = context(spark, sf_small)
    start, end = ctx.window
    tops = one_pass.learned_tops(ctx.clean)
    assert tops["city"] == [(r.city, r.n) for r in ctx.top("city", 20).collect()]
    rows, _ = one_pass.observed_rows(ctx.bookings, start, end)
    base = one_pass.base_aggregate(PR.settled_rows(rows), tops, start, end)
    plan = base._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation [") == 1
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan.executedPlan().toString()


@pytest.mark.parametrize("how", ["a row lost", "a margin changed", "a row twice"])
def test_a_corrupted_table_is_refused(spark, sf_small, tmp_out, how):
    ctx = context(spark, sf_small)
    one_pass.refresh(ctx, tmp_out)
    before = {p: os.path.getmtime(p) for p in glob.glob(os.path.join(tmp_out, "*", "*.parquet"))}

    def corrupt(tables):
        df = tables["segment_weekly"]
        tables["segment_weekly"] = {
            "a row lost": lambda: df.exceptAll(df.limit(1)), "a row twice": lambda: df.union(df.limit(1)),
            "a margin changed": lambda: df.withColumn("gm_sum", F.col("gm_sum") + F.when(F.rand(1) < 0.01, 1).otherwise(0))}[how]()
        return tables

    with pytest.raises(AssertionError, match="segment_weekly has"):
        one_pass.refresh(ctx, tmp_out, corrupt=corrupt)
    assert {p: os.path.getmtime(p) for p in glob.glob(os.path.join(tmp_out, "*", "*.parquet"))} == before
    assert not glob.glob(os.path.join(tmp_out, "_staging*"))


def test_rows_that_do_not_add_up_are_refused(spark, sf_small, tmp_out):
    from ledgerlens.plans.context import FrameContext
    bad = context(spark, sf_small)._fact.withColumn("cpt_c", F.when(F.col("booking_id") % 997 == 0, F.col("cpt_c") + 1).otherwise(
        F.col("cpt_c")))
    with pytest.raises(AssertionError, match="do not add up"):
        one_pass.refresh(FrameContext(spark, bad), tmp_out)
    assert not glob.glob(os.path.join(tmp_out, "*"))


def files_of(folder):
    found = glob.glob(os.path.join(folder, "booking_month=*", "*.parquet"))
    return {(f, os.stat(f).st_mtime_ns) for f in found}


def months_of(files):
    return {os.path.basename(os.path.dirname(f)).removeprefix("booking_month=") for f, _ in files}


def test_only_the_months_of_a_changed_file_are_rewritten(spark, sf_small, tmp_out):
    fact = context(spark, sf_small).bookings.drop("is_partial", "week_start", "cpt_c")
    for year in range(1995, 1999):
        fact.where(F.year("booking_date") == year).coalesce(1).write.parquet(os.path.join(tmp_out, f"extract_{year}"))
    pattern, folder = os.path.join(tmp_out, "extract_*"), os.path.join(tmp_out, "prepared")
    update = lambda: refresh_months(spark, pattern, folder, extracts_fact)
    whole = lambda: extracts_fact(spark, pattern).drop("_src_path")
    now = lambda: read_prepared(spark, folder).drop("booking_month")
    assert len(update()) == 48 and same(now(), whole())
    first = files_of(folder)
    assert update() == [] and files_of(folder) == first

    # one extract changes in two months of 1996; rows of the other ten months of its year stand in it, too
    changed = spark.read.parquet(os.path.join(tmp_out, "extract_1996")).withColumn(
        "net_c", F.when(F.month("booking_date").isin(3, 4), F.col("net_c") - 100).otherwise(F.col("net_c")))
    changed.coalesce(1).write.parquet(os.path.join(tmp_out, "new"))
    shutil.rmtree(os.path.join(tmp_out, "extract_1996"))
    shutil.move(os.path.join(tmp_out, "new"), os.path.join(tmp_out, "extract_1996"))
    assert update() == [f"1996-{m:02d}" for m in range(1, 13)]
    second = files_of(folder)
    assert months_of(first - second) == {f"1996-{m:02d}" for m in range(1, 13)} and same(now(), whole())

    # a further file with rows of one month only
    spark.read.parquet(os.path.join(tmp_out, "extract_1997")).where(F.month("booking_date") == 5).limit(9).withColumn(
        "booking_id", -F.col("booking_id")).coalesce(1).write.parquet(os.path.join(tmp_out, "extract_late"))
    assert update() == ["1997-05"]
    third = files_of(folder)
    assert months_of(second - third) == months_of(third - second) == {"1997-05"} and same(now(), whole())

    # a file goes, and with it the months that only it had
    shutil.rmtree(os.path.join(tmp_out, "extract_1998"))
    assert len(update()) == 12 and same(now(), whole())
    assert not {m for m in months_of(files_of(folder)) if m.startswith("1998")}


def test_refresh_from_changed_extracts(spark, sf_small, tmp_out):
    fact = context(spark, sf_small).bookings.drop("is_partial", "week_start", "cpt_c")
    single = fact.groupBy("booking_id").count().where("count = 1").select("booking_id")
    fact = fact.join(single, "booking_id", "left_semi")
    for year in (1996, 1997):
        fact.where(F.year("collection_date") == year).write.parquet(os.path.join(tmp_out, f"extract_{year}"))
    pattern, out = os.path.join(tmp_out, "extract_*"), os.path.join(tmp_out, "published")
    first = refresh_from_extracts(spark, pattern, out)
    n = spark.read.parquet(first["weekly_waterfall"]).agg(F.sum("bookings")).first()[0]
    fact.where(F.year("collection_date") == 1998).write.parquet(os.path.join(tmp_out, "extract_1998"))
    again = refresh_from_extracts(spark, pattern, out)
    assert spark.read.parquet(again["weekly_waterfall"]).agg(F.sum("bookings")).first()[0] > n
