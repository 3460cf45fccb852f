"""Ranking, week-over-week and trend operators.

Time comparisons run on weekly aggregates in long form (one row per week x line), so
every window is partitioned by the line or the group -- never a single global partition
over raw rows. Trailing windows are range windows over the day number of the weekly rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from . import prepare as PR
from .ranking import ranked
from .rollups import SUM_PARTS, rollup

GOOD_WHEN_RISING = {"bookings", "offer_sum", "net_sum", "gm_sum"}
DISCOUNT_LINES = ["special_sum", "vip_sum", "coupon_sum", "redcash_sum", "giftcard_sum"]
WATERFALL_LINES = ["bookings"] + [a for _, a in SUM_PARTS]


def top_coupons_by_category(clean: DataFrame, n: int = 5) -> DataFrame:
    pairs = (clean.filter(X.has_coupon()).groupBy("customer_category", "coupon_code")
             .agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("customer_category").orderBy(F.col("n").desc(), F.col("coupon_code").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def revenue_share(clean: DataFrame, key: str = "city") -> DataFrame:
    g = clean.groupBy(key).agg(X.sum0("net_c").alias("revenue"))
    # the total runs over the aggregated rows (one per key), in the same scan
    return g.withColumn("share_pct", X.ratio_pct("revenue", F.sum("revenue").over(Window.partitionBy())))


def waterfall_long(clean: DataFrame) -> DataFrame:
    """Weekly waterfall unpivoted to (week_start, is_partial, line, value)."""
    wf = rollup(clean, ["week_start", "is_partial"]).drop("gm_pct")
    return wf.unpivot(["week_start", "is_partial"], WATERFALL_LINES, "line", "value")


def _lagged(long: DataFrame, key: str = "line") -> DataFrame:
    w = Window.partitionBy(key).orderBy("week_start")
    prev = F.lag("value").over(w)
    return (long.withColumn("prev_value", prev)
            .withColumn("prev_partial", F.lag("is_partial").over(w)))


def wow_delta(clean: DataFrame) -> DataFrame:
    """Each waterfall line vs the previous week: value, absolute and percent change
    (percent undefined when the previous value is 0), and whether a partial week is involved."""
    lg = _lagged(waterfall_long(clean))
    return lg.select(
        "week_start", "line", "value", "prev_value",
        (F.col("value") - F.col("prev_value")).alias("abs_delta"),
        X.ratio_pct(F.col("value") - F.col("prev_value"), "prev_value").alias("pct_delta"),
        (F.col("is_partial") | F.coalesce(F.col("prev_partial"), F.lit(False))).alias("vs_partial"))


def favourability(wow: DataFrame) -> DataFrame:
    """good/bad sign: rising totals are good, rising discounts and cost are bad."""
    good_line = F.col("line").isin(*GOOD_WHEN_RISING)
    d = F.col("abs_delta")
    fav = (F.when(d.isNull(), F.lit(None).cast("string")).when(d == 0, F.lit("flat"))
           .when((good_line & (d > 0)) | (~good_line & (d < 0)), F.lit("good")).otherwise(F.lit("bad")))
    return wow.select("week_start", "line", "abs_delta", fav.alias("favourability"), "vs_partial")


def biggest_mover(wow: DataFrame) -> DataFrame:
    """Per complete week after a complete week, the discount kind with the largest absolute
    WoW percent change; kinds whose previous value is 0 are excluded."""
    d = wow.filter(F.col("line").isin(*DISCOUNT_LINES) & F.col("pct_delta").isNotNull() & ~F.col("vs_partial"))
    w = Window.partitionBy("week_start").orderBy(F.abs("pct_delta").desc(), F.col("line").asc())
    return (d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .select("week_start", "line", "pct_delta"))


def _trailing_window(keys: list[str], weeks: int):
    """The current week and the ``weeks - 1`` calendar weeks before it (missing weeks stay missing)."""
    return Window.partitionBy(*keys).orderBy(F.unix_date("week_start")).rangeBetween(-7 * (weeks - 1), 0)


def trailing_gm(clean: DataFrame, weeks: int = P.TRAILING_WEEKS) -> DataFrame:
    """Trailing margin over complete weeks; one row per week, so one window partition is small."""
    weekly = (PR.complete_weeks(clean).groupBy("week_start")
              .agg(X.sum0("gm_c").alias("gm"), X.sum0("net_c").alias("net")))
    w = _trailing_window([], weeks)
    return weekly.select("week_start", F.sum("gm").over(w).alias("trailing_gm"), F.sum("net").over(w).alias("trailing_net"),
                         F.count(F.lit(1)).over(w).alias("weeks_in_window")).withColumn(
        "trailing_gm_pct", X.ratio_pct("trailing_gm", "trailing_net"))


def trailing_gm_by_kind(clean: DataFrame, weeks: int = P.TRAILING_KIND_WEEKS) -> DataFrame:
    """Trailing trend of each discount category over complete weeks: given away in the
    window, and that as percent of the window's offer value."""
    wf = rollup(PR.complete_weeks(clean), ["week_start"])
    long = wf.unpivot(["week_start", "offer_sum"], DISCOUNT_LINES, "line", "value")
    w = _trailing_window(["line"], weeks)
    return long.select("line", "week_start", "value", F.sum("value").over(w).alias("trailing_value"),
                       F.sum("offer_sum").over(w).alias("trailing_offer"),
                       F.count(F.lit(1)).over(w).alias("weeks_in_window")).withColumn(
        "trailing_pct_of_offer", X.ratio_pct("trailing_value", "trailing_offer"))


def pct_of_offer(clean: DataFrame) -> DataFrame:
    wf = rollup(clean, ["week_start"]).drop("gm_pct", "bookings")
    lines = [a for _, a in SUM_PARTS if a != "offer_sum"]
    long = wf.unpivot(["week_start", "offer_sum"], lines, "line", "value")
    return long.select("week_start", "line", "value", X.ratio_pct("value", "offer_sum").alias("pct_of_offer"))


def wow_scorecard(clean: DataFrame) -> DataFrame:
    """Weekly bookings / GM / revenue / gm_pct with previous-week deltas (long form,
    window partitioned by metric)."""
    wk = clean.groupBy("week_start", "is_partial").agg(
        F.count(F.lit(1)).cast("double").alias("bookings"), X.sum0("gm_c").cast("double").alias("gm_sum"),
        X.sum0("net_c").cast("double").alias("revenue_sum"))
    wk = wk.withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
    long = wk.unpivot(["week_start", "is_partial"], ["bookings", "gm_sum", "revenue_sum", "gm_pct"],
                      "metric", "value")
    lg = _lagged(long, "metric")
    return lg.select("week_start", "metric", "value", "prev_value",
                     (F.col("value") - F.col("prev_value")).alias("delta"),
                     X.ratio_pct(F.col("value") - F.col("prev_value"), "prev_value").alias("pct_delta"),
                     (F.col("is_partial") | F.coalesce(F.col("prev_partial"), F.lit(False))).alias("vs_partial"))


def fresh_share_trend(clean: DataFrame, category: str = "vip gold") -> DataFrame:
    c = clean.filter(F.col("customer_category") == category)
    return (c.groupBy("week_start", "is_partial").agg(X.count_when(F.col("booking_flag") == P.FRESH).alias("fresh"),
                                        F.count(F.lit(1)).alias("total"))
            .withColumn("fresh_share", X.ratio_pct("fresh", "total")))


def _flag_trend(clean: DataFrame, keys: list[str]) -> DataFrame:
    return (clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"),
                                     X.sum0("net_c").alias("revenue_sum"), X.sum0("offer_c").alias("offer_sum"))
            .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum"))
            .withColumn("aov", F.col("offer_sum") / F.col("bookings")).drop("offer_sum"))


def fresh_repeat_trend(clean: DataFrame) -> DataFrame:
    return _flag_trend(clean, ["week_start", "is_partial", "booking_flag"])


def fresh_repeat_by_category(clean: DataFrame) -> DataFrame:
    return _flag_trend(clean, ["week_start", "is_partial", "booking_flag", "customer_category"])


def lifecycle_curve(clean: DataFrame) -> DataFrame:
    """Bookings per coupon by weeks since its first use. Bookings are first aggregated per
    (code, week), so the per-code window sees at most one row per week."""
    wk = (clean.filter(F.col("coupon_code").isNotNull()).groupBy("coupon_code", "week_start")
          .agg(F.count(F.lit(1)).alias("bookings")))
    first = F.min("week_start").over(Window.partitionBy("coupon_code"))
    return wk.select("coupon_code", "week_start", "bookings",
                     (F.datediff("week_start", first) / F.lit(7)).cast("int").alias("weeks_since_first"))


def city_aov_outlier(clean: DataFrame, ratio: float = P.AOV_OUTLIER_RATIO) -> DataFrame:
    g = clean.groupBy("city").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("offer_c").alias("offer_sum"))
    g = g.withColumn("aov", F.col("offer_sum") / F.col("bookings"))
    g = g.withColumn("median_aov", F.percentile("aov", 0.5).over(Window.partitionBy()))
    g = g.withColumn("aov_vs_median", F.col("aov") / F.col("median_aov"))
    r = F.col("aov_vs_median")
    return g.select("city", "bookings", "aov", "median_aov", "aov_vs_median",
                    ((r > ratio) | (r < 1.0 / ratio)).alias("is_outlier"))


def geo_ranking(clean: DataFrame) -> DataFrame:
    """Cities and zones ranked by gm_pct within their level."""
    cells = clean.groupBy("city", "zone").agg(X.sum0("gm_c").alias("gm"), X.sum0("net_c").alias("net"))
    level = F.explode(F.array(F.struct(F.lit("city").alias("level"), F.col("city").alias("name")),
                              F.struct(F.lit("zone").alias("level"), F.col("zone").alias("name"))))
    both = (cells.select("gm", "net", level.alias("x")).groupBy("x.level", "x.name")
            .agg(F.sum("gm").alias("gm_sum"), F.sum("net").alias("revenue_sum"))
            .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum")))
    return ranked(both, ["level"], "gm_pct", ["name"], "rank", ascending=False)


def package_ranking(clean: DataFrame) -> DataFrame:
    """Packages ranked by gm_pct within their kind (combo vs single package), over the package
    aggregate (one row per package)."""
    g = (clean.groupBy("package_code").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"),
                                           X.sum0("net_c").alias("revenue_sum"))
         .withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum")).withColumn("is_combo", X.is_combo()))
    return ranked(g, ["is_combo"], "gm_pct", ["package_code"], "rank_in_kind", ascending=False)
