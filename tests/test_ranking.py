"""Distributed ranks against SQL's windows: ties over several ranges, nulls, hot values, one row."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import percent_ranks, ranked


def rows(n, seed):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 7.0, 7.0, 7.0, 0.0, -1.5, float(rng.randrange(n))])
    return [(f"k{k}", rng.choice(["a", "a", "b", None]), value(), rng.randrange(50)) for k in range(n)] + [("one", "single", 3.0, 1)]


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("split", [True, False])
def test_rank_equals_the_window(spark, ascending, split):
    df = spark.createDataFrame(rows(3000, 1), "id string, kind string, value double, n int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not split).lower())
    try:
        order = F.col("value").asc_nulls_first() if ascending else F.col("value").desc_nulls_last()
        w = Window.partitionBy("kind").orderBy(order)
        want = {r.id: (r.rank, r.total) for r in df.withColumn("rank", F.rank().over(w)).withColumn(
            "total", F.count(F.lit(1)).over(Window.partitionBy("kind"))).collect()}
        got = ranked(df, ["kind"], "value", ["id"], "rank", ascending, "total").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(want) and {r.id: (r["rank"], r["total"]) for r in got} == want


def test_a_hot_value_lies_in_several_ranges(spark):
    df = spark.range(60_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranked(df.withColumn("g", F.lit(1)), ["g"], "v", ["id"], "r")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        sizes = [r["count"] for r in df.repartitionByRange(F.lit(1), "v", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 60_000 / 8
        ranks = {r.id: r.r for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    values = sorted(5.0 if k % 3 == 0 else float(k) for k in range(60_000))
    first = {}
    for place, v in enumerate(values, 1):
        first.setdefault(v, place)
    assert ranks == {k: first[5.0 if k % 3 == 0 else float(k)] for k in range(60_000)}


def test_percent_ranks_equal_the_window(spark):
    df = spark.createDataFrame(rows(700, 2), "id string, kind string, value double, n int").drop("kind")
    got = {r.id: (r.value_rank, r.n_rank) for r in percent_ranks(df, ["id"], {"value": False, "n": True}).collect()}
    want = df.select("id", F.percent_rank().over(Window.orderBy(F.col("value").desc())).alias("a"),
                     F.percent_rank().over(Window.orderBy("n")).alias("b")).collect()
    assert got == {r.id: (r.a, r.b) for r in want}
    assert percent_ranks(df.limit(1), ["id"], {"n": True}).first().n_rank == 0.0
    assert percent_ranks(df.limit(0), ["id"], {"n": True, "value": False}).count() == 0


@pytest.mark.parametrize("key", ["coupon_health", "package_ranking", "geo_ranking"])
def test_no_key_ranks_in_one_task(spark, sf_small, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Relation [" not in df._jdf.queryExecution().optimizedPlan().toString()
