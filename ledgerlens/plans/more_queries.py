"""Query registrations beyond the rollups: coupon policy, segments, trends, pricing, quality."""

from __future__ import annotations

from ..operators import coupons as C
from ..sources import dims as D
from .context import context
from .registry import register


def _c(spark, sf):
    return context(spark, sf)


_CHECKED: set = set()


def _rules(spark):
    """Rules with the uniqueness check (C18) run once per application."""
    rules = D.rules_union(spark)
    app = spark.sparkContext.applicationId
    if app not in _CHECKED:
        D.assert_unique(rules, "coupon_code")
        _CHECKED.add(app)
    return rules


# -- coupon policy ------------------------------------------------------------------------
register("campaign_rules")(lambda s, d: C.campaign_rules(C.campaign_aggregate(_c(s, d).clean), _rules(s)))
register("campaign_scorecard")(lambda s, d: C.campaign_scorecard(_c(s, d).clean, _rules(s)))
register("addfamily_check")(lambda s, d: C.addfamily_check(_c(s, d).clean, D.family_rules(s)))
register("stacking_curve")(lambda s, d: C.stacking_curve(_c(s, d).clean))
register("depth_curve")(lambda s, d: C.depth_curve(_c(s, d).clean, D.depth_tiers(s)))
register("rule_rows")(lambda s, d: C.rule_rows(_c(s, d).clean, _rules(s)))
register("mov_compliance")(lambda s, d: C.mov_compliance(_c(s, d).clean, _rules(s)))
register("upper_limit_breach")(lambda s, d: C.upper_limit_breach(_c(s, d).clean, _rules(s)))
register("mov_weekly")(lambda s, d: C.mov_weekly(_c(s, d).bucketed("coupon"), _rules(s)))
register("addfamily_weekly")(lambda s, d: C.addfamily_weekly(_c(s, d).clean))
register("unknown_codes")(lambda s, d: C.unknown_codes(_c(s, d).clean, _rules(s)))
register("coupon_age")(lambda s, d: C.coupon_age(_c(s, d).clean, _rules(s)))
register("top_campaigns")(lambda s, d: C.top_campaigns(_c(s, d).clean, _rules(s)))
register("over_limit_offers")(lambda s, d: C.over_limit_offers(_c(s, d).clean))
register("attention_flags")(lambda s, d: C.attention_flags(_c(s, d).clean, _rules(s)))

from . import segment_queries  # noqa: E402,F401
