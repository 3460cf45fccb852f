"""Query registry: key -> callable(spark, sf_dir) -> DataFrame.

Each entry reads the driver tables through the shared context (materialised bookings,
derived clean window) and returns a lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import rollups as R
from ..operators import quality as Q
from ..operators import prepare as PR
from .context import context

Query = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, Query] = {}


def register(key: str):
    def deco(fn):
        _REG[key] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    # import side-effect modules that register more keys
    from . import more_queries  # noqa: F401
    return dict(_REG)


def _c(spark, sf):
    return context(spark, sf)


# -- rollups ----------------------------------------------------------------------------
register("booking_weekly")(lambda s, d: R.booking_weekly(_c(s, d).bucketed("package", "city")))
register("coupon_weekly")(lambda s, d: R.coupon_weekly(_c(s, d).bucketed("coupon")))
register("package_info")(lambda s, d: R.package_info(_c(s, d).clean))
register("segment_weekly")(lambda s, d: R.segment_weekly(_c(s, d).bucketed("city")))
register("channel_weekly")(lambda s, d: R.channel_weekly(_c(s, d).bucketed("city")))
register("stacking_weekly")(lambda s, d: R.stacking_weekly(_c(s, d).clean))
register("geo_weekly")(lambda s, d: R.geo_weekly(_c(s, d).clean, _c(s, d).top))
register("daily_trend")(lambda s, d: R.daily_trend(_c(s, d).settled, _c(s, d).clean, *_c(s, d).window,
                                                        top=_c(s, d).top))
register("weekly_waterfall")(lambda s, d: R.weekly_waterfall(_c(s, d).clean))
register("package_gm")(lambda s, d: R.package_gm(_c(s, d).clean))
register("booking_cube_weekly")(lambda s, d: R.booking_cube_weekly(_c(s, d).clean, _c(s, d).top))
register("weekly_market_sku")(lambda s, d: R.weekly_market_sku(_c(s, d).settled))
register("weekly_stack")(lambda s, d: R.weekly_stack(_c(s, d).settled))
register("weekly_coupon")(lambda s, d: R.weekly_coupon(_c(s, d).settled))
register("weekly_segment")(lambda s, d: R.weekly_segment(_c(s, d).settled))
register("stack_distribution")(lambda s, d: R.stack_distribution(_c(s, d).settled))
register("negative_margin_tail")(lambda s, d: R.negative_margin_tail(_c(s, d).settled))

# -- ingest / quality -------------------------------------------------------------------
register("file_manifest")(lambda s, d: _c(s, d).manifest())
register("derive_clean_window")(lambda s, d: Q.derive_clean_window(_c(s, d).manifest()))
register("settled_rows")(lambda s, d: PR.settlement_report(_c(s, d).bookings))
