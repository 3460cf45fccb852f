"""File sources and sinks (S01, S03-S07) with declared schemas -- no inference.

* ``read_extract`` / ``read_extracts``: booking extracts (Parquet or CSV), optionally many
  files by glob, each row tagged with its file name through the ``_metadata`` column.
* ``read_template_bookings``: the public 15-column booking template (CSV) and
  ``template_to_fact``, which maps it onto the engine's cent-based fact columns.
* ``quarantine_csv`` / ``read_template_checked``: the same with unreadable rows set aside.
* ``read_json_params``: manifest / meta / truth style JSON documents.
* ``read_dimension_csv``: delimited dimensions and rollups with a header.
* ``write_tables``: one output per summary table.
* ``persist_prepared``: the prepared fact, written partitioned by month for pruning.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TEMPLATE_SCHEMA = T.StructType([
    T.StructField("booking_date", T.DateType()),
    T.StructField("market", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("coupon", T.StringType()),
    T.StructField("offer_price", T.DecimalType(18, 2)),
    T.StructField("campaign_discount", T.DecimalType(18, 2)),
    T.StructField("member_discount", T.DecimalType(18, 2)),
    T.StructField("coupon_discount", T.DecimalType(18, 2)),
    T.StructField("wallet_credit", T.DecimalType(18, 2)),
    T.StructField("gift_card", T.DecimalType(18, 2)),
    T.StructField("net_revenue", T.DecimalType(18, 2)),
    T.StructField("cost", T.DecimalType(18, 2)),
])

MANIFEST_SCHEMA = T.StructType([T.StructField("files", T.ArrayType(T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("collection_date_min", T.DateType()),
    T.StructField("collection_date_max", T.DateType()),
    T.StructField("collection_months", T.ArrayType(T.StringType())),
    T.StructField("booking_date_min", T.DateType()),
    T.StructField("booking_date_max", T.DateType()),
    T.StructField("booking_id_min", T.LongType()),
    T.StructField("booking_id_max", T.LongType()),
])))])


def read_extract(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, fmt: str = "parquet",
                 columns: list[str] | None = None) -> DataFrame:
    """One extract, all columns or a pruned set."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_extracts(spark: SparkSession, pattern: str | list[str], schema: T.StructType | None = None,
                  fmt: str = "parquet", file_col: str = "_src_file", path: bool = False) -> DataFrame:
    """All files matching a glob (or listed), each row tagged with its file's name, or path."""
    df = read_extract(spark, pattern, schema, fmt)
    return df.withColumn(file_col, F.col("_metadata.file_path" if path else "_metadata.file_name"))


def read_template_bookings(spark: SparkSession, path: str) -> DataFrame:
    """Public booking template (CSV with header). Blank coupon cells become null."""
    df = (spark.read.schema(TEMPLATE_SCHEMA).option("header", True).option("dateFormat", "yyyy-MM-dd")
          .option("emptyValue", None).csv(path))
    return df.withColumn("coupon", F.when(F.trim("coupon") != "", F.col("coupon")))


#: Share of unreadable rows above which an input is refused.
MOST_UNREADABLE = 0.01
CORRUPT = "_unreadable"


def quarantine_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, bad_dir: str,
                   most: float = MOST_UNREADABLE, **options) -> DataFrame:
    """Rows of delimited files with a header whose every cell fits the schema (S01, S05). All other
    rows are written to ``bad_dir`` as they stand, with their file; one scan counts and writes them.
    Above ``most`` of all rows the input is refused (ValueError), the bad rows being kept.

    Cells are checked in all columns, whichever are read later."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
    df = reader.options(columnNameOfCorruptRecord=CORRUPT, **options).csv(path)
    seen = Observation(f"quarantine-{uuid.uuid4().hex}")
    # Spark converts (and so checks) only the columns that a query reads: this always-true condition reads all
    also = F.hash(*[F.col(f.name) for f in schema.fields]) >= F.lit(-(1 << 31))
    counted = df.withColumn("file", F.col("_metadata.file_path")).observe(
        seen, F.count_if(also).alias("rows"), F.count(CORRUPT).alias("bad"))
    counted.where(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("line")).write.mode("overwrite").parquet(bad_dir)
    n = seen.get
    if n["bad"] > most * n["rows"]:
        raise ValueError(f"{n['bad']} of {n['rows']} rows are unreadable; they are in {bad_dir}")
    return df.where(F.col(CORRUPT).isNull() & also).drop(CORRUPT)


def read_template_checked(spark: SparkSession, path: str | list[str], bad_dir: str, most: float = MOST_UNREADABLE) -> DataFrame:
    """``read_template_bookings`` with the unreadable rows set aside."""
    df = quarantine_csv(spark, path, TEMPLATE_SCHEMA, bad_dir, most, dateFormat="yyyy-MM-dd")
    return df.withColumn("coupon", F.when(F.trim("coupon") != "", F.col("coupon")))


def _cents(c: str) -> F.Column:
    return F.round(F.col(c) * 100, 0).cast("bigint")


def template_to_fact(df: DataFrame) -> DataFrame:
    """Map template rows onto the fact columns the operators use (money in cents)."""
    kinds = ["campaign_discount", "member_discount", "coupon_discount", "wallet_credit", "gift_card"]
    out = df.select(
        F.col("booking_date"), F.col("market"), F.col("sku"), F.col("tier").alias("customer_category"),
        F.col("channel").alias("booked_by"), F.col("flag").alias("booking_flag"),
        F.col("coupon").alias("coupon_code"), _cents("offer_price").alias("offer_c"),
        _cents("campaign_discount").alias("special_c"), _cents("member_discount").alias("vip_c"),
        _cents("coupon_discount").alias("coupon_c"), _cents("wallet_credit").alias("redcash_c"),
        _cents("gift_card").alias("giftcard_c"), _cents("net_revenue").alias("net_c"), _cents("cost").alias("cpt_c"),
        sum(F.coalesce(F.col(k) != 0, F.lit(False)).cast("int") for k in kinds).alias("n_disc"))
    return (out.withColumn("gm_c", F.col("net_c") - F.col("cpt_c"))
            .withColumn("week_start", F.date_trunc("week", "booking_date").cast("date")))


def read_json_params(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A JSON document (manifest, meta, truth) as a one-row DataFrame."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """Manifest JSON exploded to one row per file (months stay an array<string>)."""
    doc = read_json_params(spark, path, MANIFEST_SCHEMA)
    return doc.select(F.explode("files").alias("f")).select("f.*")


def read_dimension_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delimited dimension or rollup with a header, declared schema."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.toDF(*[c.strip() for c in df.columns])


def write_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """One output per summary table, overwritten (S06). CSV gets a header."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(path)
        paths[name] = path
    return paths


def persist_prepared(df: DataFrame, path: str, date_col: str = "booking_date", id_col: str = "booking_id") -> str:
    """Write the prepared fact partitioned by month so window filters prune whole
    directories (S07).

    The rows are first range-partitioned on (date, id): each task then holds one
    contiguous slice of dates and writes one file into one (rarely two) month folders,
    i.e. about one file per task instead of tasks x months small files. The id breaks ties,
    so a month -- or a single day -- holding a third of all rows is cut into many slices
    written in parallel. No partition count is forced: AQE sizes the slices from the
    advisory partition size."""
    out = (df.repartitionByRange(date_col, id_col)
           .withColumn("booking_month", F.date_format(date_col, "yyyy-MM")))
    (out.sortWithinPartitions(date_col, id_col)
     .write.mode("overwrite").partitionBy("booking_month").parquet(path))
    return path


def settings_frame(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    return spark.createDataFrame(pairs, schema)

