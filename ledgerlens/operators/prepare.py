"""Preparation operators: settlement, cost repair, windows, buckets."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X


# -- P01 / P03 / P04 / P05 -----------------------------------------------------------

def clean_window(df: DataFrame, start: _dt.date, end: _dt.date, date_col: str = "booking_date") -> DataFrame:
    """Keep rows whose date lies in [start, end] (both inclusive, C15). Literal bounds push
    down to the Parquet scan."""
    return df.filter(F.col(date_col).between(F.lit(start), F.lit(end)))


def settled_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose margin has not settled (null GM), C14."""
    return df.filter(F.col("gm_c").isNotNull())


def settlement_report(df: DataFrame) -> DataFrame:
    """How many rows ``settled_rows`` drops (P03 report), one row."""
    return df.agg(F.count(F.lit(1)).alias("rows_total"),
                  X.count_when(F.col("gm_c").isNull()).alias("rows_unsettled"),
                  X.count_when(F.col("gm_c").isNotNull()).alias("rows_settled"))


def repair_cost(df: DataFrame, raw_col: str = "cpt_raw", out_col: str = "cpt_fixed_c") -> DataFrame:
    """Numeric coercion of cost; when unreadable but margin is known, cost = net - GM."""
    parsed = F.expr(f"try_cast({raw_col} AS BIGINT)")
    fixed = F.when(parsed.isNull() & F.col("gm_c").isNotNull(), F.col("net_c") - F.col("gm_c")).otherwise(parsed)
    return df.withColumn(out_col, fixed).withColumn("cost_repaired", parsed.isNull() & F.col("gm_c").isNotNull())


def with_week(df: DataFrame, date_col: str = "booking_date") -> DataFrame:
    return df.withColumn("week_start", X.week_start(date_col))


# -- P06 / P07 / P08 / P11 / P15 ------------------------------------------------

def discount_kinds(df: DataFrame, nonzero_rule: bool = True) -> DataFrame:
    n = X.n_disc_types(nonzero_rule)
    return df.withColumn("n_disc_types", n).withColumn("n_disc_bucket", X.stack_bucket(n))


def net_and_margin(df: DataFrame, parts=("special_c", "vip_c", "coupon_c", "redcash_c", "giftcard_c"),
                   offer="offer_c", cost="cpt_c") -> DataFrame:
    """net = offer - discounts; gm = net - cost; flags for negative margin and 3+ kinds."""
    net = F.col(offer)
    for p in parts:
        net = net - F.coalesce(F.col(p), F.lit(0))
    kinds = sum(X.nonzero(p).cast("int") for p in parts)
    return (df.withColumn("net_calc_c", net)
            .withColumn("gm_calc_c", net - F.col(cost))
            .withColumn("is_negative_gm", net - F.col(cost) < 0)
            .withColumn("is_3plus", kinds >= 3))


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN -> NULL at ingest: in Spark ``NaN > 15`` is true, in pandas it is false (C17)."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.when(~F.isnan(F.col(c)), F.col(c)))
    return out


# -- P09 / P10: long-tail buckets ------------------------------------------------------

def top_values(df: DataFrame, key: str, n: int) -> DataFrame:
    """Top-n non-null values of ``key`` by row count, ties by key ascending.

    Partial counts per key, then TakeOrderedAndProject keeps n rows per task: output is
    bounded by n, so it is safe to broadcast."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col(key).asc()).limit(n))


def bucket_top_n(target: DataFrame, ranking: DataFrame, key: str, n: int, out: str,
                 null_label: str | None = None) -> DataFrame:
    """Replace values outside the top-n (learned on ``ranking``) by OTHER.

    ``null_label`` labels missing keys (the intended NONE bucket for coupons, C7)."""
    return bucket_by_top(target, top_values(ranking, key, n), key, out, null_label)


def bucket_by_top(target: DataFrame, top: DataFrame, key: str, out: str,
                  null_label: str | None = None) -> DataFrame:
    """``bucket_top_n`` with an already learned top list (at most N rows, broadcast)."""
    top = top.select(F.col(key).alias("_top_key"))
    joined = target.join(F.broadcast(top), target[key] == top["_top_key"], "left")
    label = F.coalesce(F.col("_top_key"), F.lit(P.OTHER))
    if null_label is not None:
        label = F.when(F.col(key).isNull(), F.lit(null_label)).otherwise(label)
    return joined.withColumn(out, label).drop("_top_key")


def min_count_label(key: str, count: str, min_rows: int) -> Column:
    """Label of a row of per-key counts: the key, or OTHER below ``min_rows`` rows and for null."""
    return F.coalesce(F.when(F.col(count) >= min_rows, F.col(key)), F.lit(P.OTHER))


def min_count_rollup(df: DataFrame, key: str, min_rows: int, out: str, aggs: dict[str, Column]) -> DataFrame:
    """Additive aggregates (name -> expression, summed again) per value with at least ``min_rows``
    rows, the others together as OTHER: one scan, and a second aggregate over one row a value."""
    each = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[a.alias(n) for n, a in aggs.items()])
    return each.groupBy(min_count_label(key, "_n", min_rows).alias(out)).agg(*[F.sum(n).alias(n) for n in aggs])


def bucket_min_count(df: DataFrame, key: str, min_rows: int, out: str) -> DataFrame:
    """Keep values with at least ``min_rows`` rows, else OTHER.

    The per-key counts are joined back through a window-free aggregate + join; the key
    set is not size-bounded, so the join strategy is left to AQE."""
    keep = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
            .select(F.col(key).alias("_keep")))
    return (df.join(keep, df[key].eqNullSafe(keep["_keep"]), "left")
            .withColumn(out, F.coalesce(F.col("_keep"), F.lit(P.OTHER))).drop("_keep"))


# -- P12 / P18 / P19 / P20 / P23 ---------------------------------------------------------

def from_clean_start(df: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """Keep everything on/after the clean start; flag rows outside the window as partial."""
    return (df.filter(F.col("booking_date") >= F.lit(start))
            .withColumn("is_partial", ~F.col("booking_date").between(F.lit(start), F.lit(end))))


def flag_partial_weeks(df: DataFrame, first_day: _dt.date | None, last_day: _dt.date | None) -> DataFrame:
    """``is_partial``: the booking's week (Monday to Sunday) is not wholly inside
    [first_day, last_day], so weeks cut by either edge of the covered days are partial."""
    starts_before = F.col("week_start") < F.lit(first_day).cast("date")
    ends_after = F.date_add("week_start", 6) > F.lit(last_day).cast("date")
    return df.withColumn("is_partial", F.coalesce(starts_before | ends_after, F.lit(False)))


def complete_weeks(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_partial"))


def suppress_small_n(df: DataFrame, n_col: str, pct_col: str, min_n: int = P.MIN_N_FOR_PERCENTAGES) -> DataFrame:
    ok = F.col(n_col) >= min_n
    return (df.withColumn(pct_col, F.when(ok, F.col(pct_col)))
            .withColumn(pct_col + "_status", F.when(ok, F.lit("ok")).otherwise(F.lit("insufficient data"))))


def currency_view(df: DataFrame, money_cols: list[str], rate: float, suffix: str = "_fx") -> DataFrame:
    """Money columns (cents) converted to major units of another currency at ``rate``."""
    out = df
    for c in money_cols:
        out = out.withColumn(c + suffix, F.col(c) * F.lit(rate) / F.lit(100.0))
    return out


# -- P13: key / header normalisation ---------------------------------------------------

def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def normalise_key(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.trim(F.col(key).cast("string")))


# -- U01 / U02 / Q06 ---------------------------------------------------------------------

def union_extracts(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def duplicate_ids(df: DataFrame, key: str = "booking_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def extract_overlap(df: DataFrame, key: str = "booking_id", file_col: str = "source_file") -> DataFrame:
    """Ids that appear in more than one file."""
    return (df.groupBy(key).agg(F.countDistinct(file_col).alias("n_files"))
            .filter(F.col("n_files") > 1))

