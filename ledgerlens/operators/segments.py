"""Segment, channel, geography and operations views.

Shares of a grand total use a window over the rows already aggregated (one per group, bounded
by the grouping's domain), so the fact is scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from . import prepare as PR


def segment_mix(clean: DataFrame) -> DataFrame:
    g = clean.groupBy("booking_flag", "customer_category").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"),
        X.flag_share(X.has_coupon()).alias("coupon_pen"), F.avg("total_disc_pct").alias("avg_disc"),
        F.avg("total_member").alias("avg_members"))
    return (g.withColumn("gm_pct", X.ratio_pct("gm", "revenue"))
            .withColumn("rev_share", X.ratio_pct("revenue", F.sum("revenue").over(Window.partitionBy()))))


def segment_channel(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("booking_flag", "customer_category", "booked_by").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"),
        X.flag_share(X.has_coupon()).alias("coupon_pen"), F.avg("total_disc_pct").alias("avg_disc"))
        .withColumn("gm_pct", X.ratio_pct("gm", "revenue")))


def top_coupon_per_package(clean: DataFrame) -> DataFrame:
    """Most used coupon per package (count desc, code asc). The count per (package, code)
    is aggregated first, so the window sees one row per pair, never raw bookings."""
    pairs = (clean.filter(X.has_coupon()).groupBy("package_code", "coupon_code")
             .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("package_code").orderBy(F.col("n").desc(), F.col("coupon_code").asc())
    return (pairs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("package_code", F.col("coupon_code").alias("top_coupon"), F.col("n").alias("top_coupon_n")))


def package_exposure(clean: DataFrame) -> DataFrame:
    """Per package: penetration, mean discount, gm_pct, and the top coupon with its count.
    One aggregate at the finer grain (package x coupon) is rolled up, so the fact is scanned once."""
    used = F.when(X.has_coupon(), F.col("coupon_code"))
    pairs = (clean.withColumn("package_code", F.trim(F.col("package_code").cast("string")))
             .groupBy("package_code", used.alias("coupon")).agg(
                 F.count(F.lit(1)).alias("n"), X.count_when(X.has_coupon()).alias("with_coupon"),
                 F.sum("total_disc_pct").alias("disc"), F.count("total_disc_pct").alias("disc_n"),
                 F.sum("gm_c").alias("gm"), F.sum("net_c").alias("net")))
    # the least (-n, code) is the most used coupon, ties to the smaller code
    best = F.min(F.when(F.col("coupon").isNotNull(), F.struct(-F.col("n"), F.col("coupon"))))
    g = pairs.groupBy("package_code").agg(
        F.sum("n").alias("n_bookings"), F.sum("with_coupon").alias("_with"), F.sum("disc").alias("_disc"),
        F.sum("disc_n").alias("_disc_n"), F.sum("gm").alias("_gm"), F.sum("net").alias("_net"), best.alias("_best"))
    return g.select(
        "package_code", "n_bookings", (F.col("_with") / F.col("n_bookings")).alias("coupon_penetration"),
        (F.col("_disc") / F.col("_disc_n")).alias("avg_total_disc_pct"), X.ratio_pct("_gm", "_net").alias("gm_pct"),
        F.col("_best.coupon").alias("top_coupon"), (-F.col("_best.col1")).alias("top_coupon_n"))


def daily_scorecard(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("booking_date").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"),
        X.flag_share(X.has_coupon()).alias("coupon_pen"), F.avg("total_disc_pct").alias("avg_disc"),
        X.count_when(F.col("booking_flag") == P.FRESH).alias("fresh_bookings"),
        X.count_when(F.col("booking_flag") == P.REPEAT).alias("repeat_bookings"),
        X.count_when(F.col("customer_category") == "vip gold").alias("vip_gold_bookings"),
        X.count_when(F.col("booked_by") == "Self").alias("self_bookings"),
        X.count_when(F.col("booked_by") == "Sales").alias("sales_bookings"),
        X.count_when(F.col("booked_by") == "Phlebo").alias("phlebo_bookings"))
        .withColumn("gm_pct", X.ratio_pct("gm", "revenue"))
        .withColumn("fresh_pct", X.ratio("fresh_bookings", "bookings")))


def _summary(df, keys, offer=False):
    from .rollups import summary
    return summary(df, keys, with_offer=offer)


def agent_weekly(clean: DataFrame, n: int = P.TOP_N["agent20"], top: DataFrame | None = None) -> DataFrame:
    """``top`` is the learned list of the n busiest agents when the caller holds it (cached)."""
    sales = clean.filter(F.col("booked_by") == "Sales")
    b = PR.bucket_by_top(sales, PR.top_values(sales, "agent_id", n) if top is None else top, "agent_id", "agent_bucket")
    return _summary(b.drop("agent_id").withColumnRenamed("agent_bucket", "agent_id"), ["week_start", "agent_id"])


def agent_leaderboard(clean: DataFrame, floor: int = P.AGENT_FLOOR) -> DataFrame:
    sales = clean.filter((F.col("booked_by") == "Sales") & F.col("agent_id").isNotNull())
    return _summary(sales, ["agent_id"], offer=True).filter(F.col("bookings") >= floor)


def slot_status(events: DataFrame) -> DataFrame:
    """Collection slot (hour of day) x status counts, over the event stream table."""
    return (events.groupBy(F.hour("ts").alias("collection_slot"), F.col("event_type").alias("pickup_status"))
            .agg(F.count(F.lit(1)).alias("bookings")))


def premium_split(clean: DataFrame) -> DataFrame:
    return (clean.groupBy("is_premium").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"),
        X.sum0("offer_c").alias("offer_sum"))
        .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
        .withColumn("aov", F.col("offer_sum") / F.col("bookings")))


def combo_vs_single(clean: DataFrame) -> DataFrame:
    return _summary(clean.withColumn("is_combo", X.is_combo()), ["is_combo"], offer=True)


SEGMENT_COLS = [f"{f.lower()}_{c.replace(' ', '_')}" for f in (P.FRESH, P.REPEAT) for c in P.CATEGORIES]


def city_segment_matrix(clean: DataFrame) -> DataFrame:
    """city x (flag-category) pivot of gm_pct, and of AOV (``<segment>_aov``); pivot values are
    listed so Spark skips the distinct-values pass."""
    seg = F.concat(F.lower("booking_flag"), F.lit("_"), F.regexp_replace("customer_category", " ", "_"))
    out = (clean.withColumn("segment", seg).groupBy("city").pivot("segment", SEGMENT_COLS)
           .agg(X.ratio_pct(F.sum("gm_c"), F.sum("net_c")).alias("gm_pct"),
                X.ratio(F.sum("offer_c"), F.count("offer_c")).alias("aov")))
    for c in SEGMENT_COLS:
        out = out.withColumnRenamed(f"{c}_gm_pct", c)
    return out


STACK_COLS = {"0": "k0", "1": "k1", "2": "k2", "3+": "k3plus"}


def stacking_heatmap(clean: DataFrame) -> DataFrame:
    out = (clean.withColumn("kinds", X.stack_bucket("n_disc")).groupBy("week_start")
           .pivot("kinds", list(STACK_COLS)).agg(X.ratio_pct(F.sum("gm_c"), F.sum("net_c"))))
    for k, v in STACK_COLS.items():
        out = out.withColumnRenamed(k, v)
    return out


def channel_split(clean: DataFrame) -> DataFrame:
    """week x channel: volume share of the week, channel and blended gm_pct, discount, AOV.
    The week totals come from a window partitioned by week over the aggregated rows."""
    g = clean.groupBy("week_start", "booked_by").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"),
        X.sum0("offer_c").alias("offer_sum"), F.avg("total_disc_pct").alias("avg_discount_pct"))
    w = Window.partitionBy("week_start")
    return (g.withColumn("volume_share", X.ratio_pct("bookings", F.sum("bookings").over(w)))
            .withColumn("blended_gm_pct", X.ratio_pct(F.sum("gm_sum").over(w), F.sum("revenue_sum").over(w)))
            .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
            .withColumn("aov", F.col("offer_sum") / F.col("bookings")).drop("offer_sum"))


def attach_rates(clean: DataFrame) -> DataFrame:
    return clean.groupBy("customer_category", "booked_by").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.flag_share(F.col("express_fee_c") > 0).alias("express_attach"),
        X.flag_share(F.col("hardcopy_fee_c") > 0).alias("hardcopy_attach"))


def category_share_by_package(clean: DataFrame, category: str = "vip gold") -> DataFrame:
    return clean.groupBy("package_code").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.flag_share(F.col("customer_category") == category).alias("category_share"))


KIND_NAMES = {"special_c": "special", "vip_c": "vip", "coupon_c": "coupon", "redcash_c": "redcash",
              "giftcard_c": "giftcard"}


def isolated_kind_margin(clean: DataFrame) -> DataFrame:
    """gm_pct and cost % of price where exactly one named discount kind is present
    (``none`` for undiscounted bookings)."""
    only = F.when(F.col("n_disc") == 0, F.lit("none"))
    for c, name in KIND_NAMES.items():
        only = only.when((F.col("n_disc") == 1) & (F.col(c) > 0), F.lit(name))
    return (clean.withColumn("only_kind", only).filter(F.col("only_kind").isNotNull())
            .groupBy("only_kind").agg(
                F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"),
                X.sum0("net_c").alias("revenue_sum"), X.sum0("cpt_c").alias("cost_sum"),
                X.sum0("offer_c").alias("offer_sum"))
            .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
            .withColumn("cost_pct_of_offer", X.ratio_pct("cost_sum", "offer_sum")))


def named_pair_margin(clean: DataFrame, pair: tuple[str, str] = ("coupon_c", "vip_c")) -> DataFrame:
    """gm_pct and cost % of price of the bookings that stack exactly the two named kinds, next to
    those that carry only one of them."""
    a, b = pair
    kind = (F.when((F.col("n_disc") == 2) & (F.col(a) > 0) & (F.col(b) > 0), F.lit(f"{KIND_NAMES[a]}+{KIND_NAMES[b]}"))
            .when((F.col("n_disc") == 1) & (F.col(a) > 0), F.lit(KIND_NAMES[a]))
            .when((F.col("n_disc") == 1) & (F.col(b) > 0), F.lit(KIND_NAMES[b])))
    return (clean.withColumn("kinds", kind).filter(F.col("kinds").isNotNull()).groupBy("kinds").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"),
        X.sum0("cpt_c").alias("cost_sum"), X.sum0("offer_c").alias("offer_sum"))
        .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
        .withColumn("cost_pct_of_offer", X.ratio_pct("cost_sum", "offer_sum")))


def aov_gap(clean: DataFrame) -> DataFrame:
    """Per city: fresh AOV / repeat AOV from conditional sums (one pass)."""
    fresh = F.col("booking_flag") == P.FRESH
    g = clean.groupBy("city").agg(
        X.sum0(F.when(fresh, F.col("offer_c"))).alias("fresh_offer"), X.count_when(fresh).alias("fresh_n"),
        X.sum0(F.when(~fresh, F.col("offer_c"))).alias("repeat_offer"), X.count_when(~fresh).alias("repeat_n"))
    fa = X.ratio("fresh_offer", "fresh_n")
    ra = X.ratio("repeat_offer", "repeat_n")
    return g.select("city", fa.alias("fresh_aov"), ra.alias("repeat_aov"), (fa / F.when(ra != 0, ra)).alias("aov_gap"))


def settlement_curve(bookings: DataFrame) -> DataFrame:
    """booking month x months-to-collect: share and cumulative share of the month.
    Windows are partitioned by booking month over the aggregated rows."""
    bm = F.trunc("booking_date", "MM")
    lag = F.months_between(F.trunc("collection_date", "MM"), bm).cast("int")
    g = bookings.groupBy(bm.alias("booking_month"), lag.alias("months_to_collect")).agg(
        F.count(F.lit(1)).alias("bookings"))
    w = Window.partitionBy("booking_month")
    wc = w.orderBy("months_to_collect").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (g.withColumn("share_pct", X.ratio_pct("bookings", F.sum("bookings").over(w)))
            .withColumn("cum_share_pct", X.ratio_pct(F.sum("bookings").over(wc), F.sum("bookings").over(w))))


def daily_completeness(bookings: DataFrame) -> DataFrame:
    """Per day: rows, unsettled share, rows / median daily rows, settled flag. The median
    is a window over the daily aggregate (one row per day)."""
    d = bookings.groupBy("booking_date").agg(
        F.count(F.lit(1)).alias("rows"), X.count_when(F.col("gm_c").isNull()).alias("null_gm_rows"))
    med = F.percentile("rows", 0.5).over(Window.partitionBy())
    return (d.withColumn("null_gm_share", X.ratio("null_gm_rows", "rows"))
            .withColumn("rows_vs_median", F.col("rows") / med)
            .withColumn("settled", F.col("null_gm_rows") == 0))
