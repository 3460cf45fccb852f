"""Ingest profile and data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X


def file_manifest(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Per-file profile: rows, collection/booking date range, distinct collection months
    (sorted, comma-joined), id range, and a note when a file spans several months.

    The month set per file is bounded by the calendar, so collecting it is safe."""
    month = F.date_format("collection_date", "yyyy-MM")
    months = F.array_sort(F.collect_set(month))
    return (df.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("collection_date").alias("collection_date_min"),
        F.max("collection_date").alias("collection_date_max"),
        F.array_join(months, ",").alias("collection_months"),
        F.size(months).alias("n_months"),
        F.min("booking_date").alias("booking_date_min"),
        F.max("booking_date").alias("booking_date_max"),
        F.min("booking_id").alias("booking_id_min"),
        F.max("booking_id").alias("booking_id_max"))
        .withColumn("note", F.when(F.col("n_months") > 1, F.lit("spans several months")).otherwise(F.lit(""))))


def derive_clean_window(manifest: DataFrame) -> DataFrame:
    """start = first day of the earliest single-month file; end = last day of the month
    before the latest covered month. One row."""
    first_month = F.trunc("collection_date_min", "MM")
    return manifest.agg(
        F.min(F.when(F.col("n_months") == 1, first_month)).alias("clean_start"),
        F.last_day(F.add_months(F.trunc(F.max("collection_date_max"), "MM"), -1)).alias("clean_end"))


def waterfall_reconcile(waterfall: DataFrame) -> DataFrame:
    """Per complete week: offer - discounts - net and net - cost - gm, exact in cents."""
    d1 = (F.col("offer_sum") - F.col("special_sum") - F.col("vip_sum") - F.col("coupon_sum")
          - F.col("redcash_sum") - F.col("giftcard_sum") - F.col("net_sum"))
    d2 = F.col("net_sum") - F.col("cpt_sum") - F.col("gm_sum")
    return (waterfall.filter(~F.col("is_partial"))
            .select("week_start", d1.alias("discount_gap_c"), d2.alias("margin_gap_c"),
                    ((d1 == 0) & (d2 == 0)).alias("reconciles")))


def rollup_totals_agree(totals: DataFrame, reference_name: str = "weekly_waterfall") -> DataFrame:
    """Compare each rollup's total GM with the waterfall's; tolerance max(1, 1e-6 * total)
    (in currency units, i.e. 100 cents)."""
    # a window over one row a rollup: nothing is computed again for the reference
    ref = F.max(F.when(F.col("rollup") == reference_name, F.col("gm_total"))).over(Window.partitionBy())
    t = totals.withColumn("waterfall_gm_total", ref)
    ref = F.col("waterfall_gm_total")
    tol = F.greatest(F.lit(100.0), F.abs(ref) * F.lit(1e-6))
    return t.select("rollup", "gm_total", "waterfall_gm_total", (F.col("gm_total") - ref).alias("diff_c"),
                    (F.abs(F.col("gm_total") - ref) < tol).alias("agrees"))


def null_margin_guard(clean: DataFrame) -> DataFrame:
    return clean.agg(X.count_when(F.col("gm_c").isNull()).alias("null_gm_rows"),
                     F.count(F.lit(1)).alias("rows")).withColumn("passes", F.col("null_gm_rows") == 0)


def settings_duplicates(settings: DataFrame, key: str = "key") -> DataFrame:
    k = F.trim(F.col(key))
    return settings.groupBy(k.alias(key)).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def banned_tokens(docs: DataFrame, banned_hashes: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  pattern: str = P.TOKEN_PATTERN) -> DataFrame:
    """Tokens whose SHA-256 of the lower-cased form is listed; hits per document.

    Tokens are produced per row by ``regexp_extract_all`` over the whole text and hashed
    JVM-side; the (small) banned list is joined as a left-semi join."""
    toks = docs.select(id_col, F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"({pattern})"), 1))
                       .alias("token"))
    # sha2 is nullable in Catalyst, so the join would get an inferred isnotnull(sha2(...))
    # filter below the projection and hash every token twice; a non-nullable key avoids it.
    hashed = toks.withColumn("token_hash", F.coalesce(F.sha2(F.lower("token"), 256), F.lit("")))
    hits = hashed.join(banned_hashes.select("token_hash"), "token_hash", "left_semi")
    return hits.groupBy(id_col).agg(F.count(F.lit(1)).alias("hits"),
                                    F.countDistinct("token_hash").alias("distinct_tokens"))
