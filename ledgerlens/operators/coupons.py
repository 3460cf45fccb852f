"""Coupon-policy operators: scorecard, compliance, curves.

Compliance is one join with the uniqueness-checked rules and one aggregate for all codes. The
rules are not hinted: Spark broadcasts them while their measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X


def _rules(rules: DataFrame, cols: list[str]) -> DataFrame:
    return rules.select("coupon_code", *cols)


def campaign_aggregate(clean: DataFrame) -> DataFrame:
    """Per coupon code (null codes dropped, C5): volume, money, mean percents and shares."""
    return (clean.filter(F.col("coupon_code").isNotNull()).groupBy("coupon_code").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.sum0("net_c").alias("revenue"),
        X.sum0("gm_c").alias("gm"),
        F.avg("total_disc_pct").alias("avg_total_disc_pct"),
        F.avg("coupon_pct").alias("avg_coupon_disc_pct"),
        F.avg("total_member").alias("avg_members"),
        X.flag_share(F.col("booking_flag") == P.FRESH).alias("fresh_pct"),
        X.flag_share(F.col("booked_by") == "Self").alias("self_pct"),
        X.flag_share(F.col("vip_c") > 0).alias("vip_stack_pct"))
        .withColumn("gm_pct", X.ratio_pct("gm", "revenue")))


def campaign_rules(campaign: DataFrame, rules: DataFrame) -> DataFrame:
    """Campaign aggregate LEFT JOIN rules on code; ``known_in_crm`` = matched."""
    r = _rules(rules, ["mov_c", "discount", "upper_limit", "rule_type"]).withColumn("_m", F.lit(True))
    return (campaign.join(r, "coupon_code", "left")
            .withColumn("known_in_crm", F.coalesce(F.col("_m"), F.lit(False))).drop("_m"))


def campaign_scorecard(clean: DataFrame, rules: DataFrame) -> DataFrame:
    return campaign_rules(campaign_aggregate(clean), rules)


def addfamily_check(clean: DataFrame, family: DataFrame) -> DataFrame:
    """Family add-on codes: volume, mean/max total discount, shares, and how often the
    total discount exceeds the family cap."""
    caps = family.select("coupon_code", F.col("upper_limit").alias("cap_pct"))
    rows = clean.join(caps, "coupon_code")
    return rows.groupBy("coupon_code", "cap_pct").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("total_disc_pct").alias("avg_total_disc_pct"),
        F.max("total_disc_pct").alias("max_total_disc_pct"),
        X.flag_share(F.col("vip_c") > 0).alias("vip_stack_share"),
        F.avg("total_member").alias("avg_members"),
        X.flag_share(F.col("booking_flag") == P.FRESH).alias("fresh_share"),
        X.flag_share(F.col("booked_by") == "Self").alias("self_share"),
        X.flag_share(F.col("total_disc_pct") > F.col("cap_pct")).alias("over_cap_share"))


def stacking_curve(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(F.col("n_disc").alias("n_disc_types")).agg(
        F.count(F.lit(1)).alias("n"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"))
        .withColumn("gm_pct", X.ratio_pct("gm", "revenue")))


def depth_curve(clean: DataFrame, tiers: DataFrame) -> DataFrame:
    """Isolated-coupon depth curve in fixed tier order; empty tiers kept (right join to the
    tier list, which is a fixed 7-row dimension)."""
    agg = (clean.withColumn("depth_tier", X.depth_tier("n_disc")).filter(F.col("depth_tier").isNotNull())
           .groupBy("depth_tier").agg(F.count(F.lit(1)).alias("n"), X.sum0("net_c").alias("revenue"),
                                      X.sum0("gm_c").alias("gm")))
    out = tiers.join(agg, "depth_tier", "left")
    return out.select("tier_order", "depth_tier",
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                      F.coalesce("revenue", F.lit(0)).cast("bigint").alias("revenue"),
                      F.coalesce("gm", F.lit(0)).cast("bigint").alias("gm"),
                      X.ratio_pct("gm", "revenue").alias("gm_pct"))


def rule_rows(clean: DataFrame, rules: DataFrame) -> DataFrame:
    """Per-row compliance in one join + conditional aggregate."""
    r = _rules(rules, ["mov_c", "upper_limit"])
    rows = clean.join(r, "coupon_code")
    return rows.groupBy("coupon_code", "mov_c", "upper_limit").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.count_when(F.col("offer_c") < F.col("mov_c")).alias("below_mov"),
        X.count_when(F.col("coupon_pct") > F.col("upper_limit") + F.lit(P.UPPER_LIMIT_TOLERANCE))
        .alias("over_upper_limit"))


def mov_compliance(clean: DataFrame, rules: DataFrame, min_bookings: int = P.COMPLIANCE_MIN_BOOKINGS) -> DataFrame:
    """Coupons with MOV > 0 and enough bookings: share priced below the stated MOV.
    (Proxy: the package price, not the cart value.)"""
    rr = rule_rows(clean, rules).filter((F.col("mov_c") > 0) & (F.col("bookings") >= min_bookings))
    return rr.select("coupon_code", "mov_c", "bookings",
                     X.ratio("below_mov", "bookings").alias("pct_bookings_below_stated_mov"))


def upper_limit_breach(clean: DataFrame, rules: DataFrame, min_bookings: int = P.COMPLIANCE_MIN_BOOKINGS,
                       list_share: float = P.BREACH_LIST_SHARE) -> DataFrame:
    rr = rule_rows(clean, rules).filter((F.col("upper_limit") > 0) & (F.col("bookings") >= min_bookings))
    out = rr.select("coupon_code", "upper_limit", "bookings",
                    X.ratio("over_upper_limit", "bookings").alias("pct_bookings_over_upper_limit"))
    return out.filter(F.col("pct_bookings_over_upper_limit") > list_share)


def mov_weekly(bucketed: DataFrame, rules: DataFrame) -> DataFrame:
    """week x coupon bucket: bookings under the row's own coupon MOV."""
    r = _rules(rules, ["mov_c"])
    rows = bucketed.join(r, "coupon_code", "left")
    out = rows.groupBy("week_start", "coupon_bucket").agg(
        F.count(F.lit(1)).alias("bookings"),
        X.count_when(F.col("offer_c") < F.col("mov_c")).alias("bookings_below_mov"))
    return out.withColumn("pct_below_mov", X.ratio_pct("bookings_below_mov", "bookings"))


def addfamily_weekly(clean: DataFrame, family_codes: list[str] = P.FAMILY_CODES) -> DataFrame:
    fam = clean.filter(F.col("coupon_code").isin(family_codes))
    return fam.groupBy("week_start", F.col("coupon_code").alias("coupon_bucket")).agg(
        F.count(F.lit(1)).alias("bookings"),
        F.avg("total_member").alias("avg_total_member"),
        F.avg("total_disc_pct").alias("avg_discount_pct"),
        X.flag_share(F.col("vip_c") > 0).alias("pct_vip_stacked"),
        X.flag_share(F.col("booked_by") == "Self").alias("pct_self_channel"))


def unknown_codes(clean: DataFrame, rules: DataFrame) -> DataFrame:
    """Codes in use that have no rule (left anti join with the rules)."""
    used = clean.filter(F.col("coupon_code").isNotNull()).groupBy("coupon_code").agg(
        F.count(F.lit(1)).alias("bookings"))
    return used.join(_rules(rules, []), "coupon_code", "left_anti")


def coupon_age(clean: DataFrame, rules: DataFrame) -> DataFrame:
    """Weekly coupon rollup with weeks since the rule was created (null dates tolerated)."""
    wk = clean.filter(F.col("coupon_code").isNotNull()).groupBy("week_start", "coupon_code").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"))
    out = wk.join(_rules(rules, ["create_date"]), "coupon_code", "left")
    return out.withColumn("weeks_since_create",
                          F.floor(F.datediff("week_start", "create_date") / F.lit(7.0)).cast("int"))


def over_limit_offers(clean: DataFrame, ceiling: int = P.OVER_LIMIT_CEILING) -> DataFrame:
    """Coupons whose depth exceeds the ceiling, with bookings and margin at stake."""
    return (clean.filter(F.col("coupon_pct") > ceiling).groupBy("coupon_code").agg(
        F.count(F.lit(1)).alias("bookings"), F.max("coupon_pct").alias("depth_pct"),
        X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"),
        X.sum0("coupon_c").alias("coupon_sum")).withColumn("gm_pct", X.ratio_pct("gm_sum", "revenue_sum")))


def attention_flags(clean: DataFrame, rules: DataFrame, min_bookings: int = P.COMPLIANCE_MIN_BOOKINGS) -> DataFrame:
    """Threshold marks: below-MOV share > 10 % (of coupons with a MOV and enough bookings),
    campaign gm_pct < 55 %. One aggregate of the rows with their rule, for both marks."""
    rows = clean.filter(F.col("coupon_code").isNotNull()).join(_rules(rules, ["mov_c"]), "coupon_code", "left")
    out = rows.groupBy("coupon_code", "mov_c").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"),
        X.count_when(F.col("offer_c") < F.col("mov_c")).alias("below_mov"))
    judged = (F.col("mov_c") > 0) & (F.col("bookings") >= min_bookings)
    out = out.withColumn("gm_pct", X.ratio_pct("gm", "revenue")).withColumn(
        "pct_bookings_below_stated_mov", F.when(judged, X.ratio("below_mov", "bookings")))
    return out.select(
        "coupon_code", "bookings", "gm_pct", "pct_bookings_below_stated_mov",
        F.coalesce(F.col("pct_bookings_below_stated_mov") > P.MOV_ATTENTION_SHARE, F.lit(False)).alias("mov_attention"),
        F.coalesce(F.col("gm_pct") < P.CAMPAIGN_GM_ATTENTION, F.lit(False)).alias("gm_attention"))


def top_campaigns(clean: DataFrame, rules: DataFrame, k: int = 30) -> DataFrame:
    """The k biggest campaigns (a top-k report; the limit is the feature). Total order:
    bookings desc, code asc, so the cut is deterministic; planned as TakeOrderedAndProject
    (each task keeps k rows)."""
    sc = campaign_scorecard(clean, rules)
    return sc.orderBy(F.col("bookings").desc(), F.col("coupon_code").asc()).limit(k)
