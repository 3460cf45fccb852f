"""The ``bookings`` fact: one row per line item, mapped from the driver tables.

Money is integer cents (LongType) so every engine adds exact values. The mapping is
declared with the DataFrame API; Catalyst prunes each scan to the columns used and AQE
picks the join strategies from measured sizes (nation/region are fixed 25/5-row
dimensions and are broadcast explicitly). Joins and the deal by month move the narrow rows of
``booked_lines``; ``mapped`` widens them where they are written.

Fresh/Repeat needs the rank of an order among its customer's orders. Only the first
three matter, so the rank is computed as a filtered ``row_number`` (Spark plans a
map-side WindowGroupLimit, so a customer holding a third of all orders ships at most
three rows per map task) and joined back on the unique order key.

``bookings(spark, sf_dir)`` writes the fact once per dataset version into the shared folder and
returns a lazy scan of it; ``is_partial`` is added by the query context.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, exists
from .tables import read_table, table_path

_LOCK = threading.Lock()
_CACHE: dict = {}

UNSETTLED_FROM = _dt.date(2001, 7, 1)   # open lines booked on/after this date have no margin yet


def pct_points(c: Column) -> Column:
    """A 0-1 fraction as whole percentage points (half rounds up)."""
    return F.floor(c * 100 + F.lit(0.5)).cast("int")


def share_of(offer: Column, pct: Column) -> Column:
    """floor(offer * pct / 100) in cents."""
    return F.floor(offer * pct / F.lit(100.0)).cast("bigint")


def spread(line: DataFrame) -> DataFrame:
    """A fact stored in fewer splits than the cluster has cores is dealt out by a per-row id (no
    business key, so nothing can pile up) so that its wide projection uses every core; a widely
    split fact is left as it is."""
    cores = line.sparkSession.sparkContext.defaultParallelism
    if line.rdd.getNumPartitions() >= cores:
        return line
    return line.repartition(2 * cores, F.monotonically_increasing_id())


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    rank_w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    first_three = (orders.select("o_orderkey", "o_custkey", "o_orderdate")
                   .withColumn("_rn", F.row_number().over(rank_w))
                   .filter(F.col("_rn") <= 3)
                   .select("o_orderkey", F.lit(True).alias("_fresh")))

    # first three before customer: the customer join then re-deals the orders by customer, so the
    # line join reads both of its inputs through an exchange of its own, which skew handling can split
    return (orders.join(first_three, "o_orderkey", "left")
            .join(customer, orders.o_custkey == customer.c_custkey)
            .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("booking_date"), "c_nationkey",
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE", "vip gold")
                    .when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "vip").otherwise("regular")
                    .alias("customer_category"),
                    F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Self")
                    .when(F.col("o_orderpriority").isin("3-MEDIUM", "5-LOW"), "Sales").otherwise("Phlebo").alias("booked_by"),
                    F.coalesce("_fresh", F.lit(False)).alias("_fresh")))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def booked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with what the mapping needs of their order, customer and part: the narrow rows
    that are shuffled, from which ``mapped`` derives the fact's columns."""
    line = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    orders = _customer_orders(spark, sf_dir)
    # the part side is narrow: key, sku, premium flag
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type", "p_retailprice"]).select(
        "p_partkey", "p_type", (F.col("p_retailprice") >= 950).alias("p_premium"))
    # No side is hinted: Spark broadcasts what its measured size allows and splits skewed
    # partitions of the sort-merge joins otherwise.
    line = spread(line)
    j = (line.join(orders, line.l_orderkey == orders.o_orderkey)
         .join(part, line.l_partkey == part.p_partkey))

    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"), "booking_date",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "o_custkey", "c_nationkey", "p_type", "p_premium", "_fresh", "customer_category",
        "booked_by")


def mapped(lines: DataFrame, geo: DataFrame) -> DataFrame:
    """The fact's rows from ``booked_lines``; no shuffle (nation and region are broadcast)."""
    j = lines.join(F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey)
    # Layered projections: each derived value is computed once and referenced by name in
    # the next layer, which keeps the generated code of the fused stage small enough for
    # the JIT (one flat select with repeated sub-expressions was ~10x slower).
    l1 = j.select(
        "booking_id", "booking_date", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        "l_linestatus", "o_custkey", "n_name", "r_name", "p_type", "_fresh", "customer_category", "booked_by",
        F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5)).cast("bigint").alias("offer_c"),
        pct_points(F.col("l_discount")).alias("disc_pt"),
        pct_points(F.col("l_tax")).alias("tax_pt"),
        (F.col("l_discount") > F.lit(0.005)).alias("has_coupon"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 4).alias("total_member"),
        F.col("p_premium").alias("is_premium"))

    offer, cat = F.col("offer_c"), F.col("customer_category")
    zero = F.lit(0).cast("bigint")
    l2 = l1.select(
        "*",
        F.when(F.col("has_coupon"), F.col("disc_pt") * 4).otherwise(F.lit(0)).alias("coupon_pct"),
        F.when(F.col("tax_pt") % 3 == 0, F.lit(0)).when(cat == "vip gold", F.lit(15))
        .when(cat == "vip", F.lit(10)).otherwise(F.lit(0)).alias("vip_pt"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.lit(5)).otherwise(F.lit(0))
        .alias("special_pt"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(3)).otherwise(F.lit(0)).alias("redcash_pt"),
        F.when(F.col("l_orderkey") % 23 == 0, F.lit(10)).otherwise(F.lit(0)).alias("giftcard_pt"))

    def amount(pt: str) -> Column:
        return F.when(F.col(pt) > 0, share_of(offer, F.col(pt))).otherwise(zero)

    l3 = l2.select("*", amount("special_pt").alias("special_c"), amount("vip_pt").alias("vip_c"),
                   amount("coupon_pct").alias("coupon_c"), amount("redcash_pt").alias("redcash_c"),
                   amount("giftcard_pt").alias("giftcard_c"))
    kinds = ("special_c", "vip_c", "coupon_c", "redcash_c", "giftcard_c")
    l4 = l3.select(
        "*",
        sum((F.col(c) > 0).cast("int") for c in kinds).alias("n_disc"),
        (F.col("coupon_pct") + F.col("vip_pt") + F.col("special_pt") + F.col("redcash_pt")
         + F.col("giftcard_pt")).alias("total_disc_pct"),
        (offer - F.col("special_c") - F.col("vip_c") - F.col("coupon_c") - F.col("redcash_c")
         - F.col("giftcard_c")).alias("net_c"))
    l5 = l4.select(
        "*", share_of(offer, F.lit(18) + F.col("l_partkey") % 20 + 5 * F.least(F.col("n_disc"), F.lit(3)))
        .alias("cpt_c"),
        F.date_add("booking_date", (F.col("l_partkey") % 45).cast("int")).alias("collection_date"))
    unsettled = (F.col("l_linestatus") == "O") & (F.col("booking_date") >= F.lit(UNSETTLED_FROM))
    out = l5.select(
        "booking_id", "booking_date", "collection_date",
        F.concat(F.lit("PL"), (F.col("l_partkey") % 200).cast("string"),
                 F.when(F.col("l_linenumber") == 7,
                        F.concat(F.lit(",PL"), (F.col("l_suppkey") % 10).cast("string"))).otherwise(F.lit("")))
        .alias("package_code"),
        F.when(F.col("has_coupon"), F.concat(F.lit("CPN"), F.col("coupon_pct").cast("string"), F.lit("_"),
                                             (F.col("l_suppkey") % 6).cast("string"))).alias("coupon_code"),
        F.col("n_name").alias("city"), F.col("r_name").alias("market"), F.col("p_type").alias("sku"),
        F.concat(F.lit("Z"), (F.col("l_suppkey") % 100).cast("string")).alias("zone"),
        "customer_category",
        F.when(F.col("_fresh"), "Fresh").otherwise("Repeat").alias("booking_flag"),
        "booked_by",
        F.when(F.col("booked_by") == "Sales", F.concat(F.lit("AG"), (F.col("o_custkey") % 40).cast("string")))
        .alias("agent_id"),
        "total_member", "is_premium", "offer_c", "coupon_pct", "special_c", "vip_c", "coupon_c", "redcash_c",
        "giftcard_c",
        F.when(F.col("l_linenumber") == 2, F.lit(4900)).otherwise(F.lit(0)).cast("bigint").alias("express_fee_c"),
        F.when(F.col("l_partkey") % 7 == 0, F.lit(2500)).otherwise(F.lit(0)).cast("bigint").alias("hardcopy_fee_c"),
        "n_disc", "total_disc_pct", "net_c", "cpt_c",
        F.when(unsettled, F.lit(None).cast("bigint")).otherwise(F.col("net_c") - F.col("cpt_c")).alias("gm_c"),
        F.when(F.col("l_orderkey") % 31 == 0, F.lit("n/a")).otherwise(F.col("cpt_c").cast("string")).alias("cpt_raw"),
        F.date_trunc("week", F.col("booking_date")).cast("date").alias("week_start"),
        F.concat(F.lit("raw_"), F.date_format("collection_date", "yyyy-MM")).alias("source_file"),
    )
    return out


def build_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lazy mapping from the driver tables (no ``is_partial``; see module doc)."""
    return mapped(booked_lines(spark, sf_dir), _geo(spark, sf_dir))


SOURCES = ("lineitem", "orders", "customer", "part", "nation", "region")
#: Bytes of the line item files for one partition of the fact's write.
LINE_BYTES = 4 << 20
#: Most bytes of a file that one scan task of the build reads: its shuffle's rows then fit the task's memory.
SCAN_BYTES = 16 << 20
MAPPING_VERSION = 2   # raise when the mapping below changes, so that no older fact is read


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def dataset_uri(spark: SparkSession, sf_dir: str) -> str:
    """The folder's full URI, as its file system qualifies it."""
    fs, path = _fs(spark, sf_dir.rstrip("/"))
    return fs.makeQualified(path).toString()


def dataset_version(spark: SparkSession, sf_dir: str) -> str:
    """Hash of the full URI, the mapping and the length, file count and time of every source
    table: equal for equal data in any application, different for folders that look alike."""
    parts = [dataset_uri(spark, sf_dir), str(MAPPING_VERSION)]
    for t in SOURCES:
        fs, path = _fs(spark, table_path(sf_dir, t))
        size = fs.getContentSummary(path)
        parts.append(f"{t}:{size.getLength()}:{size.getFileCount()}:{fs.getFileStatus(path).getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]


def fact_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of all versions of one dataset's fact."""
    name = hashlib.sha256(dataset_uri(spark, sf_dir).encode()).hexdigest()[:24]
    return f"{checkpoint_dir(spark)}/ledgerlens/bookings/{name}"


def drop_old_facts(spark: SparkSession, sf_dir: str) -> int:
    """Delete the versions of this dataset's fact that are not the present one."""
    fs, folder = _fs(spark, fact_folder(spark, sf_dir))
    keep, gone = dataset_version(spark, sf_dir), 0
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        if status.getPath().getName() != keep:
            gone += bool(fs.delete(status.getPath(), True))
    return gone


def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items that the fact's inner joins drop, by the side that is missing (one row each)."""
    line = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey"])
    part = read_table(spark, sf_dir, "part", ["p_partkey"])
    sides = {"order": line.join(orders, line.l_orderkey == orders.o_orderkey, "left_anti"),
             "part": line.join(part, line.l_partkey == part.p_partkey, "left_anti"),
             "customer": line.join(orders.join(customer, orders.o_custkey == customer.c_custkey, "left_anti"),
                                   F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")}
    out = None
    for name, df in sides.items():
        n = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("missing"), "rows")
        out = n if out is None else out.unionByName(n)
    return out


def month_parts(spark: SparkSession) -> list[Column]:
    """Month, and the part of the month by a hash of the id: about as many parts in all months
    together as there are shuffle partitions, eight a month at least."""
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 64)
    return [F.trunc("booking_date", "MM"), F.pmod(F.xxhash64("booking_id"), F.lit(parts))]


def fact_files(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the fact's write: one for each ``LINE_BYTES`` of line items, so that a task's
    sort fits its memory at every size, whatever the session's number of shuffle partitions."""
    fs, path = _fs(spark, table_path(sf_dir, "lineitem"))
    return max(2 * spark.sparkContext.defaultParallelism, -(-fs.getContentSummary(path).getLength() // LINE_BYTES))


@contextmanager
def small_splits(spark: SparkSession):
    """Scans planned inside have splits of at most ``SCAN_BYTES``."""
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(SCAN_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def dealt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``booked_lines`` dealt out by month and a hash of the id, sorted by date. The rows are
    shuffled and sorted before ``mapped`` widens them, which takes a fraction of the bytes."""
    return (booked_lines(spark, sf_dir).repartition(fact_files(spark, sf_dir), *month_parts(spark))
            .sortWithinPartitions("booking_date", "booking_id"))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bookings fact, written once per dataset version and read by every later application.

    It is dealt out by month and a hash of the id and sorted by date, so a file holds few months
    and a date filter skips whole files or row groups; a hot month or day is cut by the id. No range
    is sampled, which would compute the join twice. The write
    goes to a folder of its own and is renamed when complete, so readers never see half a fact."""
    key = (spark.sparkContext.applicationId, dataset_version(spark, sf_dir))
    with _LOCK:
        if key not in _CACHE:
            path = f"{fact_folder(spark, sf_dir)}/{key[1]}"
            if not exists(spark, path + "/_SUCCESS"):
                part = f"{path}.{spark.sparkContext.applicationId}"
                with small_splits(spark):
                    mapped(dealt_lines(spark, sf_dir), _geo(spark, sf_dir)).write.mode("overwrite").parquet(part)
                fs, made = _fs(spark, part)
                if not fs.rename(made, _fs(spark, path)[1]) and not exists(spark, path + "/_SUCCESS"):
                    raise RuntimeError(f"the fact could not be put at {path}")
            # one DataFrame per (application, dataset): the file listing happens once
            _CACHE[key] = spark.read.parquet(path)
        return _CACHE[key]
