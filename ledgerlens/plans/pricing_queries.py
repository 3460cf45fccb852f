"""Registrations for pricing and policy keys."""

from __future__ import annotations

from ..operators import pricing as M
from ..operators import segments as G
from ..sources import dims as D
from ..sources.tables import read_table
from .context import context
from .registry import register


def _c(spark, sf):
    return context(spark, sf)


def _ev(spark):
    return D.price_event_markets(spark)


def _part(spark, sf):
    return read_table(spark, sf, "part", ["p_type", "p_retailprice"])


register("event_window_range")(lambda s, d: M.event_window_range(_c(s, d).clean, _ev(s),
                                                                 cells=_c(s, d).daily_cells))
register("price_event_daily")(lambda s, d: M.price_event_daily(_c(s, d).clean, _ev(s), cells=_c(s, d).daily_cells))
register("price_event_impact")(lambda s, d: M.price_event_impact(_c(s, d).clean, _ev(s), D.rules_union(s),
                                                                 cells=_c(s, d).daily_cells))
register("arc_elasticity")(lambda s, d: M.arc_elasticity(
    M.price_event_impact(_c(s, d).clean, _ev(s), cells=_c(s, d).daily_cells), _ev(s)))
register("did_elasticity")(lambda s, d: M.did_elasticity(_c(s, d).settled, _ev(s), D.promo_events(s),
                                                         panel=_c(s, d).panel))
register("elastic_projection")(lambda s, d: M.elastic_projection(_c(s, d).settled, _ev(s), D.promo_events(s),
                                                                 panel=_c(s, d).panel))
register("did_pairing")(lambda s, d: M.did_pairing(_c(s, d).settled, _ev(s), panel=_c(s, d).panel))
register("price_event_rows")(lambda s, d: M.price_event_rows(_part(s, d), _ev(s), D.market_multipliers(s)))
register("flat_volume_impact")(lambda s, d: M.flat_volume_impact(_c(s, d).settled, _part(s, d), _ev(s),
                                                                 D.market_multipliers(s), panel=_c(s, d).panel))
register("competitor_gap")(lambda s, d: M.competitor_gap(_part(s, d), D.competitor_prices_wide(s), _ev(s)))
register("competitor_gap_by_city")(lambda s, d: M.competitor_gap_by_city(
    _c(s, d).clean, _part(s, d), D.competitor_prices_wide(s), _ev(s)))
register("price_action_exposure")(lambda s, d: M.price_action_exposure(D.price_actions(s),
                                                                       G.package_exposure(_c(s, d).clean)))
register("stacking_risk")(lambda s, d: M.stacking_risk(D.price_actions(s), G.package_exposure(_c(s, d).clean)))
register("risk_driver")(lambda s, d: M.risk_driver(M.stacking_risk(D.price_actions(s),
                                                                   G.package_exposure(_c(s, d).clean))))
register("breakeven_elasticity")(lambda s, d: M.breakeven_elasticity(_c(s, d).clean))
register("cap_scenarios")(lambda s, d: M.cap_scenarios(_c(s, d).settled))
register("coupon_health")(lambda s, d: M.coupon_health(_c(s, d).clean))

from . import quality_queries  # noqa: E402,F401
