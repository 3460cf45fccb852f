"""Column expressions shared by the operators. All native Catalyst expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P

def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonzero(c) -> Column:
    """Null-safe ``c != 0`` (null counts as zero)."""
    return F.coalesce(col(c), F.lit(0)) != 0


def ratio_pct(num, den) -> Column:
    """100 * num / den as a double, null when the denominator is zero or null."""
    den = col(den)
    return F.lit(100.0) * col(num) / F.when(den != 0, den)


def ratio(num, den) -> Column:
    den = col(den)
    return col(num).cast("double") / F.when(den != 0, den)


def flag_share(pred: Column) -> Column:
    """Mean of a predicate where missing counts as false but stays in the denominator."""
    return F.avg(F.coalesce(pred, F.lit(False)).cast("int"))


def count_when(pred: Column) -> Column:
    return F.sum(F.coalesce(pred, F.lit(False)).cast("int")).cast("bigint")


def sum0(c) -> Column:
    """Sum that is 0 over only-missing rows (C4)."""
    return F.coalesce(F.sum(col(c)), F.lit(0)).cast("bigint")


def n_disc_types(nonzero_rule: bool = True) -> Column:
    """Count of discount kinds present. ``nonzero_rule`` counts != 0 (null -> 0), the
    alternative counts > 0; they differ only for negative amounts (C10)."""
    if nonzero_rule:
        return sum(nonzero(c).cast("int") for c in P.DISCOUNT_KINDS)
    return sum(F.coalesce(F.col(c) > 0, F.lit(False)).cast("int") for c in P.DISCOUNT_KINDS)


def stack_bucket(n) -> Column:
    n = col(n)
    return F.when(n >= 3, F.lit("3+")).otherwise(n.cast("string"))


def has_coupon() -> Column:
    return F.coalesce(F.col("coupon_c") > 0, F.lit(False))


def coupon_share_of_offer() -> Column:
    """coupon / offer as a fraction; null when the offer is not positive."""
    return F.when(F.col("offer_c") > 0, F.col("coupon_c") / F.col("offer_c"))


def depth_tier(n_disc="n_disc") -> Column:
    """Depth tier by definition: no discount, or coupon-only with its depth; unknown % -> 'unknown' (C11).

    Rows with other kinds present get null (they are not isolated-coupon bookings)."""
    n = col(n_disc)
    p = coupon_share_of_offer()
    coupon_only = (n == 1) & (F.col("coupon_c") > 0)
    t = P.DEPTH_TIERS
    return (F.when(n == 0, F.lit(t[0]))
            .when(coupon_only & p.isNull(), F.lit(t[6]))
            .when(coupon_only & (p < P.DEPTH_CUTS[0]), F.lit(t[1]))
            .when(coupon_only & (p < P.DEPTH_CUTS[1]), F.lit(t[2]))
            .when(coupon_only & (p < P.DEPTH_CUTS[2]), F.lit(t[3]))
            .when(coupon_only & (p < P.DEPTH_CUTS[3]), F.lit(t[4]))
            .when(coupon_only, F.lit(t[5])))


def is_combo(c="package_code") -> Column:
    return F.coalesce(F.col(c).contains(","), F.lit(False))


def risk_flag(pen="coupon_penetration", disc="avg_total_disc_pct", chg="actual_price_pct_change") -> Column:
    """Ordered stacking-risk rules (null-safe: a missing input never satisfies a rule)."""
    pen, disc, chg = col(pen), col(disc), col(chg)
    return (F.when(pen.isNull(), F.lit(P.RISK_NO_DATA))
            .when(F.coalesce((chg < 0) & (pen > 0.5) & (disc > 15), F.lit(False)), F.lit(P.RISK_HIGH))
            .when(F.coalesce((chg > 0) & (pen < 0.15), F.lit(False)), F.lit(P.RISK_LOW_CLEAN))
            .when(pen > 0.5, F.lit(P.RISK_MEDIUM))
            .otherwise(F.lit(P.RISK_LOW)))


def round_half_up(c, digits: int = 1) -> Column:
    """Presentation rounding that gives the same answer in every engine."""
    k = 10 ** digits
    return F.floor(col(c) * k + F.lit(0.5)) / F.lit(float(k))


def week_start(c="booking_date") -> Column:
    return F.date_trunc("week", col(c)).cast("date")
