"""Registrations for ranking, week-over-week and trend keys."""

from __future__ import annotations

from ..operators import trends as W
from .context import context
from .registry import register


def _c(spark, sf):
    return context(spark, sf)


register("top5_coupon_by_category")(lambda s, d: W.top_coupons_by_category(_c(s, d).clean))
register("revenue_share")(lambda s, d: W.revenue_share(_c(s, d).clean))
register("wow_delta")(lambda s, d: W.wow_delta(_c(s, d).clean))
register("favourability")(lambda s, d: W.favourability(W.wow_delta(_c(s, d).clean)))
register("biggest_mover")(lambda s, d: W.biggest_mover(W.wow_delta(_c(s, d).clean)))
register("trailing_gm")(lambda s, d: W.trailing_gm(_c(s, d).clean))
register("trailing_gm_by_kind")(lambda s, d: W.trailing_gm_by_kind(_c(s, d).clean))
register("pct_of_offer")(lambda s, d: W.pct_of_offer(_c(s, d).clean))
register("wow_scorecard")(lambda s, d: W.wow_scorecard(_c(s, d).clean))
register("fresh_share_trend")(lambda s, d: W.fresh_share_trend(_c(s, d).clean))
register("fresh_repeat_trend")(lambda s, d: W.fresh_repeat_trend(_c(s, d).clean))
register("fresh_repeat_by_category")(lambda s, d: W.fresh_repeat_by_category(_c(s, d).clean))
register("lifecycle_curve")(lambda s, d: W.lifecycle_curve(_c(s, d).clean))
register("city_aov_outlier")(lambda s, d: W.city_aov_outlier(_c(s, d).clean))
register("geo_ranking")(lambda s, d: W.geo_ranking(_c(s, d).clean))
register("package_ranking")(lambda s, d: W.package_ranking(_c(s, d).clean))

from . import pricing_queries  # noqa: E402,F401
