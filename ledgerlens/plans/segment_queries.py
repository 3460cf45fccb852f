"""Registrations for segment, channel, geography and operations keys."""

from __future__ import annotations

from ..operators import segments as G
from ..sources.tables import read_table
from .context import context
from .registry import register


def _c(spark, sf):
    return context(spark, sf)


register("segment_mix")(lambda s, d: G.segment_mix(_c(s, d).clean))
register("segment_channel")(lambda s, d: G.segment_channel(_c(s, d).clean))
register("top_coupon_per_package")(lambda s, d: G.top_coupon_per_package(_c(s, d).clean))
register("package_exposure")(lambda s, d: G.package_exposure(_c(s, d).clean))
register("daily_scorecard")(lambda s, d: G.daily_scorecard(_c(s, d).clean))
register("agent_weekly")(lambda s, d: G.agent_weekly(_c(s, d).clean, top=_c(s, d).top_agents))
register("agent_leaderboard")(lambda s, d: G.agent_leaderboard(_c(s, d).clean))
register("slot_status")(lambda s, d: G.slot_status(read_table(s, d, "events", ["ts", "event_type"])))
register("premium_split")(lambda s, d: G.premium_split(_c(s, d).clean))
register("combo_vs_single")(lambda s, d: G.combo_vs_single(_c(s, d).clean))
register("city_segment_matrix")(lambda s, d: G.city_segment_matrix(_c(s, d).clean))
register("stacking_heatmap")(lambda s, d: G.stacking_heatmap(_c(s, d).clean))
register("channel_split")(lambda s, d: G.channel_split(_c(s, d).clean))
register("attach_rates")(lambda s, d: G.attach_rates(_c(s, d).clean))
register("category_share_by_package")(lambda s, d: G.category_share_by_package(_c(s, d).clean))
register("isolated_kind_margin")(lambda s, d: G.isolated_kind_margin(_c(s, d).clean))
register("named_pair_margin")(lambda s, d: G.named_pair_margin(_c(s, d).clean))
register("aov_gap")(lambda s, d: G.aov_gap(_c(s, d).clean))
register("settlement_curve")(lambda s, d: G.settlement_curve(_c(s, d).bookings))
register("daily_completeness")(lambda s, d: G.daily_completeness(_c(s, d).bookings))

from . import trend_queries  # noqa: E402,F401
