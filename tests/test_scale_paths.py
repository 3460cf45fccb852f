"""The large-data code paths, exercised on small data.

* With broadcasts off the fact is built with sort-merge joins (the 100 TB plan) and must
  still equal the SQL mapping row for row.
* The Fresh/Repeat rank keeps a map-side WindowGroupLimit, and it is correct when one
  customer holds a third of all orders (checked against a brute-force rank).
"""

import re

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.oracle.bookings_sql import with_bookings
from ledgerlens.sources import bookings as B
from tools.oracle_check import table_hash

COLS = ["booking_id", "booking_date", "package_code", "coupon_code", "city", "market", "sku", "booking_flag",
        "booked_by", "offer_c", "coupon_c", "vip_c", "net_c", "cpt_c", "gm_c", "n_disc", "source_file"]


def _sql_mapping_hash(sf):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    cur = con.execute(with_bookings("SELECT " + ", ".join(COLS) + " FROM bookings_base"))
    drows = cur.fetchall()
    return len(drows), table_hash([d[0] for d in cur.description], drows, None)[0]


@pytest.fixture()
def no_broadcast(spark):
    """Nothing is broadcast by size, as with tables too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sort_merge_build_equals_sql(spark, sf_small, no_broadcast):
    df = B.build_bookings(spark, sf_small).select(*COLS)
    rows = [tuple(r) for r in df.collect()]
    assert (len(rows), table_hash(COLS, rows, None)[0]) == _sql_mapping_hash(sf_small)


def test_line_join_reads_both_sides_through_their_own_exchange(spark, sf_small, no_broadcast):
    """Both inputs of the line x orders join are shuffles made for it, the shape that skew
    handling can split."""
    plan = B.build_bookings(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if "SortMergeJoin [l_orderkey" in x)
    below = [x for x in lines[at + 1:] if "Exchange" in x]
    assert "hashpartitioning(l_orderkey" in below[0]
    assert any("hashpartitioning(o_orderkey" in x and "ENSURE_REQUIREMENTS" in x for x in below)
    customer = next(k for k, x in enumerate(lines) if "[o_custkey" in x and "SortMergeJoin" in x)
    first = next(k for k, x in enumerate(lines) if "SortMergeJoin [o_orderkey" in x)
    assert customer < first  # the customer join stands between, so the orders are dealt anew


def test_hot_order_builds_whole(spark, sf_small, tmp_out, no_broadcast):
    """A third of all line items on one order: the fact keeps every row."""
    import shutil
    for t in ("region", "nation", "customer", "part", "orders"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_out)
    line = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    hot = line.select(F.min("l_orderkey")).first()[0]
    line.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(hot)).otherwise(
        F.col("l_orderkey"))).write.parquet(f"{tmp_out}/lineitem.parquet")
    assert B.build_bookings(spark, tmp_out).count() == line.count()


def test_fact_path_is_stable_and_collision_free(spark, sf_small, tmp_out):
    import os
    import shutil
    for name in ("a/b_c", "a_b/c"):
        shutil.copytree(sf_small, os.path.join(tmp_out, name))
    one, two = (B.fact_folder(spark, os.path.join(tmp_out, n)) for n in ("a/b_c", "a_b/c"))
    assert one != two
    first = B.dataset_version(spark, sf_small)
    assert first == B.dataset_version(spark, sf_small + "/")
    B.bookings(spark, sf_small)
    files = set(spark.read.parquet(f"{B.fact_folder(spark, sf_small)}/{first}").inputFiles())
    B._CACHE.clear()                                       # as another application would
    assert set(B.bookings(spark, sf_small).inputFiles()) == files
    assert B.drop_old_facts(spark, sf_small) == 0


def test_orphan_lines_are_counted(spark, sf_small, tmp_out):
    import shutil
    for t in ("region", "nation", "customer", "part", "orders"):
        shutil.copy(f"{sf_small}/{t}.parquet", tmp_out)
    line = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    line.withColumn("l_partkey", F.when(F.col("l_linenumber") == 1, F.lit(-1)).otherwise(
        F.col("l_partkey"))).write.parquet(f"{tmp_out}/lineitem.parquet")
    got = {r["missing"]: r["rows"] for r in B.orphan_lines(spark, tmp_out).collect()}
    assert got == {"order": 0, "customer": 0, "part": line.where("l_linenumber = 1").count()}


def test_first_three_rank_with_hot_customer(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    n = orders.count()
    # reassign a third of all orders to one customer
    skewed = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    top3 = skewed.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 3").select("o_orderkey")
    plan = top3._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {r[0] for r in top3.collect()}
    pdf = skewed.toPandas().sort_values(["o_custkey", "o_orderdate", "o_orderkey"])
    want = set(pdf.groupby("o_custkey").head(3)["o_orderkey"])
    assert got == want and len(got) < n


def test_spread_scan_only_when_narrow(spark, sf_small):
    from ledgerlens.sources.tables import read_table, spread_scan
    docs = read_table(spark, sf_small, "documents", ["doc_id", "text"])
    cores = spark.sparkContext.defaultParallelism
    assert docs.rdd.getNumPartitions() < cores          # one row group: a single scan task
    spread = spread_scan(docs, "doc_id")
    assert spread.rdd.getNumPartitions() == 2 * cores
    assert sorted(r[0] for r in spread.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())
    wide = docs.repartition(cores)
    assert spread_scan(wide, "doc_id") is wide           # already split: no extra shuffle


def test_token_scan_single_exchange(spark, sf_small):
    """The per-document aggregate reuses the doc_id distribution of the spread scan."""
    import __spark_entry__ as E
    df = E.queries()["banned_tokens"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


ONE_SCAN = ["segment_mix", "stack_distribution", "revenue_share", "city_aov_outlier", "daily_completeness",
            "trailing_gm", "trailing_gm_by_kind", "cap_scenarios", "package_exposure",
            "bookings_scope", "package_gm", "bucket_min_count", "attention_flags", "competitor_gap", "stacking_risk", "price_action_exposure"]


def test_one_scan_of_the_fact(spark, sf_small):
    """Totals, medians, trailing sums and roll-ups come from one scan."""
    import __spark_entry__ as E
    for key in ONE_SCAN:
        plan = E.queries()[key](spark, sf_small)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1, key
    for key, scans in (("rollup_totals_agree", 5), ("bucket_top_n", 1)):  # five rollups; the cached lists have none
        plan = E.queries()[key](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"FileScan parquet", plan.split("InMemoryTableScan")[0] if key == "bucket_top_n" else plan)) == scans, key


def test_fact_write_computes_the_join_once(spark, sf_small):
    """Hash parts by month and id: no range exchange, so nothing is sampled."""
    plan = B.build_bookings(spark, sf_small).repartition(*B.month_parts(spark)).sortWithinPartitions(
        "booking_date", "booking_id")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    months = B.bookings(spark, sf_small).groupBy(F.input_file_name(), F.trunc("booking_date", "MM")).count()
    assert months.count() < 20 * B.bookings(spark, sf_small).select(F.trunc("booking_date", "MM")).distinct().count()


def test_fact_rows_are_shuffled_narrow(spark, sf_small, no_broadcast):
    """Every exchange and sort of the fact's write moves joined source columns; what the mapping
    derives (codes, cents, discount kinds) is added after them. The rows are those of the mapping."""
    df = B.mapped(B.dealt_lines(spark, sf_small), B._geo(spark, sf_small))
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    moved = max(k for k, x in enumerate(plan) if "trunc(" in x and "Exchange" in x)
    derived = [k for k, x in enumerate(plan) if " AS package_code" in x or " AS net_c" in x or "n_name" in x and "Join" in x]
    assert derived and max(derived) < moved                # plans print from the top: the exchange is below
    assert not any("coupon_c" in x or "gm_c" in x for x in plan[moved:])
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    got = B.bookings(spark, sf_small)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
    want = B.build_bookings(spark, sf_small)
    assert got.columns == want.columns and got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_fact_write_grows_in_partitions(spark, sf_small, monkeypatch):
    """More line items make more partitions of the write, not larger ones, at one session setting."""
    few = B.dealt_lines(spark, sf_small).rdd.getNumPartitions()
    monkeypatch.setattr(B, "LINE_BYTES", 1024)
    assert B.dealt_lines(spark, sf_small).rdd.getNumPartitions() > 4 * few


def test_extracts_are_written_without_a_shuffle(spark, sf_small):
    from ledgerlens.plans.context import context
    from ledgerlens.plans.quality_queries import extract_rows
    plan = extract_rows(context(spark, sf_small).bookings)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_rules_join_leaves_the_fact_in_place(spark, sf_small):
    """The rules' size is known when the join is planned: no exchange of the fact by coupon code
    stands below the aggregate."""
    import __spark_entry__ as E
    for key in ("addfamily_check", "rule_rows", "mov_compliance", "upper_limit_breach", "mov_weekly", "attention_flags"):
        plan = E.queries()[key](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan, key
