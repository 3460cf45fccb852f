"""Published rollups (A01-A11, A20-A25) and the generic ``rollup`` helper.

Every rollup is one ``groupBy().agg()`` -- Spark plans a partial (map-side) aggregate,
one shuffle on the grouping keys, and a final aggregate. Long-tail dimensions are
bucketed first (broadcast join of at most N keys), so output stays in the low thousands
of rows whatever the input size. Money is summed in integer cents.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from . import prepare as PR

SUM_PARTS = [("offer_c", "offer_sum"), ("special_c", "special_sum"), ("vip_c", "vip_sum"),
             ("coupon_c", "coupon_sum"), ("redcash_c", "redcash_sum"), ("giftcard_c", "giftcard_sum"),
             ("net_c", "net_sum"), ("cpt_c", "cpt_sum"), ("gm_c", "gm_sum")]


def rollup(df: DataFrame, keys: list, extra: dict[str, Column] | None = None) -> DataFrame:
    """bookings + the nine money sums + gm_pct (= 100 gm / net) per key, plus extras."""
    aggs = [F.count(F.lit(1)).alias("bookings")] + [X.sum0(c).alias(a) for c, a in SUM_PARTS]
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    return df.groupBy(*keys).agg(*aggs).withColumn("gm_pct", X.ratio_pct("gm_sum", "net_sum"))


def summary(df: DataFrame, keys: list, extra: dict[str, Column] | None = None,
            with_offer: bool = False) -> DataFrame:
    """bookings, gm_sum, revenue_sum, gm_pct (+ asp when ``with_offer``) per key."""
    aggs = [F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"),
            X.sum0("net_c").alias("revenue_sum")]
    if with_offer:
        aggs.append(X.sum0("offer_c").alias("_offer_sum"))
    aggs += [v.alias(k) for k, v in (extra or {}).items()]
    out = df.groupBy(*keys).agg(*aggs).withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
    if with_offer:
        out = out.withColumn("asp", F.col("_offer_sum") / F.col("bookings")).drop("_offer_sum")
    return out


# -- production rollups ------------------------------------------------------------------

def booking_weekly(bucketed: DataFrame) -> DataFrame:
    return summary(bucketed, ["week_start", "package_bucket", "city_bucket"])


def coupon_weekly(bucketed: DataFrame) -> DataFrame:
    out = summary(bucketed, ["week_start", "coupon_bucket"], {
        "repeat_bookings": X.count_when(F.col("booking_flag") == P.REPEAT),
        "avg_discount_pct": F.avg("coupon_pct")})
    return out.withColumn("repeat_share", X.ratio_pct("repeat_bookings", "bookings"))


def package_info(clean: DataFrame, n: int = P.TOP_N["package80"]) -> DataFrame:
    top = PR.top_values(clean, "package_code", n)
    return top.select("package_code", F.col("n").alias("bookings"),
                      F.when(X.is_combo(), F.lit("combo booking")).otherwise(F.lit("")).alias("note"))


def segment_weekly(bucketed: DataFrame) -> DataFrame:
    return summary(bucketed, ["week_start", "customer_category", "booking_flag", "city_bucket"], with_offer=True)


def channel_weekly(bucketed: DataFrame) -> DataFrame:
    return summary(bucketed, ["week_start", "booked_by", "city_bucket"],
                   {"avg_discount_pct": F.avg("total_disc_pct")})


def stacking_weekly(clean: DataFrame) -> DataFrame:
    df = clean.withColumn("n_disc_types", X.stack_bucket(X.n_disc_types(True)))
    return summary(df, ["week_start", "n_disc_types"])


def geo_weekly(clean: DataFrame, top=None) -> DataFrame:
    """``top(key, n)`` gives learned top lists (cached by the context); else they are learned here."""
    top = top or (lambda key, n: PR.top_values(clean, key, n))
    df = PR.bucket_by_top(clean, top("city", P.TOP_N["city20"]), "city", "city_b")
    df = PR.bucket_by_top(df, top("zone", P.TOP_N["zone30"]), "zone", "zone_b")
    return summary(df.drop("city", "zone").withColumnRenamed("city_b", "city").withColumnRenamed("zone_b", "zone"),
                   ["week_start", "city", "zone"], with_offer=True)


def daily_trend(settled: DataFrame, clean: DataFrame, start: _dt.date, end: _dt.date, top=None) -> DataFrame:
    """Daily table over everything from the clean start on; top-N learned on the clean
    window, applied to the wider frame (C9); days outside the window flagged partial."""
    src = settled.filter(F.col("booking_date") >= F.lit(start))
    top = top or (lambda key, n: PR.top_values(clean, key, n))
    src = PR.bucket_by_top(src, top("package_code", P.TOP_N["package15"]), "package_code", "package_bucket")
    src = PR.bucket_by_top(src, top("city", P.TOP_N["city6"]), "city", "city_bucket")
    out = summary(src, ["booking_date", "package_bucket", "city_bucket"])
    return out.withColumn("is_partial", ~F.col("booking_date").between(F.lit(start), F.lit(end)))


def weekly_waterfall(clean: DataFrame) -> DataFrame:
    """Flagship: per week offer, five discounts, net, cost and margin (cents)."""
    return rollup(clean, ["week_start", "is_partial"])


def package_gm(clean: DataFrame, min_rows: int = P.MIN_PACKAGE_ROWS) -> DataFrame:
    """One aggregate by package; packages below ``min_rows`` become OTHER and are summed again."""
    out = PR.min_count_rollup(clean, "package_code", min_rows, "package_code", {
        "bookings": F.count(F.lit(1)), "gm_sum": X.sum0("gm_c"), "revenue_sum": X.sum0("net_c"), "_offer": X.sum0("offer_c")})
    return (out.withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
            .withColumn("asp", F.col("_offer") / F.col("bookings")).drop("_offer").withColumn("is_combo", X.is_combo()))


def booking_cube_weekly(clean: DataFrame, top=None) -> DataFrame:
    top = top or (lambda key, n: PR.top_values(clean, key, n))
    df = PR.bucket_by_top(clean, top("package_code", P.TOP_N["package80"]), "package_code", "package_bucket")
    df = PR.bucket_by_top(df, top("city", P.TOP_N["city15"]), "city", "city_bucket")
    return summary(df, ["week_start", "package_bucket", "city_bucket", "customer_category", "booking_flag"],
                   {"cost_sum": X.sum0("cpt_c"), "avg_total_disc_pct": F.avg("total_disc_pct")},
                   with_offer=True)


# -- published weekly tables (nine sums) --------------------------------------------------

def _coupon_label() -> Column:
    return F.coalesce(F.col("coupon_code"), F.lit(P.NONE_COUPON))


def weekly_market_sku(settled: DataFrame) -> DataFrame:
    return rollup(settled, ["week_start", "is_partial", "market", "sku"])


def weekly_stack(settled: DataFrame) -> DataFrame:
    df = settled.withColumn("n_disc_types", X.stack_bucket("n_disc")).withColumnRenamed("customer_category", "tier")
    return rollup(df, ["week_start", "is_partial", "n_disc_types", "tier"])


def weekly_coupon(settled: DataFrame) -> DataFrame:
    df = settled.withColumn("coupon", _coupon_label())
    return rollup(df, ["week_start", "is_partial", "coupon"], {
        "repeat_bookings": X.count_when(F.col("booking_flag") == P.REPEAT),
        "bookings_3plus": X.count_when(F.col("n_disc") >= 3),
        "bookings_negative_gm": X.count_when(F.col("gm_c") < 0)})


def weekly_segment(settled: DataFrame) -> DataFrame:
    df = (settled.withColumnRenamed("customer_category", "tier").withColumnRenamed("booking_flag", "flag")
          .withColumnRenamed("booked_by", "channel"))
    return rollup(df, ["week_start", "is_partial", "market", "tier", "flag", "channel"])


def stack_distribution(settled: DataFrame) -> DataFrame:
    """Discount kinds over complete weeks: share of bookings and gm_pct.

    The grand total is a window over the (four-row) aggregate."""
    full = PR.complete_weeks(settled).withColumn("n_disc_types", X.stack_bucket("n_disc"))
    g = full.groupBy("n_disc_types").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("net_sum"),
                                         X.sum0("gm_c").alias("gm_sum"))
    return (g.withColumn("share_pct", X.ratio_pct("bookings", F.sum("bookings").over(Window.partitionBy())))
            .withColumn("gm_pct", X.ratio_pct("gm_sum", "net_sum")))


def negative_margin_tail(settled: DataFrame) -> DataFrame:
    full = PR.complete_weeks(settled).withColumn("coupon", _coupon_label())
    return (full.groupBy("coupon").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.count_when(F.col("gm_c") < 0).alias("negative_gm_bookings"),
        X.sum0(F.when(F.col("gm_c") < 0, F.col("gm_c"))).alias("gm_lost_on_negative"))
        .withColumn("negative_gm_share_pct", X.ratio_pct("negative_gm_bookings", "bookings")))
