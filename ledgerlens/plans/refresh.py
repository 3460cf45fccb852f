"""End-to-end plans.

``refresh_rollups`` is the rollup refresh: prepare once (materialised fact, derived clean
window), then the ten published summary tables from two scans (``one_pass``). ``model_tables``
returns the analytical-model outputs (scorecard, compliance, curves, segments, risk,
daily tracker) as lazy DataFrames. Nothing is collected; each table is one Spark job
when written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..operators import coupons as C
from ..operators import prepare as PR
from ..operators import pricing as M
from ..operators import rollups as R
from ..operators import segments as G
from ..sources import dims as D
from ..sources.files import read_extracts
from ..sources.incremental import read_prepared, refresh_months
from . import one_pass
from .context import Context, FrameContext, context


def rollup_tables(ctx: Context) -> dict[str, DataFrame]:
    clean, settled = ctx.clean, ctx.settled
    return {
        "booking_weekly": R.booking_weekly(ctx.bucketed("package", "city")),
        "coupon_weekly": R.coupon_weekly(ctx.bucketed("coupon")),
        "package_info": R.package_info(clean),
        "segment_weekly": R.segment_weekly(ctx.bucketed("city")),
        "channel_weekly": R.channel_weekly(ctx.bucketed("city")),
        "stacking_weekly": R.stacking_weekly(clean),
        "geo_weekly": R.geo_weekly(clean, ctx.top),
        "daily_trend": R.daily_trend(settled, clean, *ctx.window, top=ctx.top),
        "weekly_waterfall": R.weekly_waterfall(clean),
        "package_gm": R.package_gm(clean),
    }


def publish(ctx: Context, out_dir: str, fmt: str, unique_ids: bool) -> dict[str, str]:
    """The ten tables from two scans of the fact, in place only if all counts agree; unique ids are
    a question of their own, which takes a shuffle by id."""
    if unique_ids and (twice := PR.duplicate_ids(ctx.clean).limit(1).collect()):
        raise AssertionError(f"booking id {twice[0]['booking_id']} is not unique")
    return one_pass.refresh(ctx, out_dir, fmt)


def refresh_rollups(spark: SparkSession, sf_dir: str, out_dir: str, fmt: str = "parquet",
                    unique_ids: bool = False) -> dict[str, str]:
    """Write, check and publish the ten summary tables. The driver tables repeat line
    numbers within an order, so unique ids are demanded on request only."""
    return publish(context(spark, sf_dir), out_dir, fmt, unique_ids)


def extracts_fact(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Booking extracts (Parquet files by glob or by path) as the prepared fact: trimmed headers and
    keys, NaN amounts as null, unreadable cost repaired from net and margin, week start; each row
    with the path of its file."""
    raw = PR.normalise_headers(read_extracts(spark, files, file_col="_src_path", path=True))
    for key in ("package_code", "coupon_code"):
        raw = PR.normalise_key(raw, key).withColumn(key, F.when(F.col(key) != "", F.col(key)))
    amounts = [f.name for f in raw.schema.fields if f.name.endswith("_c")]
    raw = PR.nan_to_null(raw, [f.name for f in raw.schema.fields if f.dataType.typeName() in ("double", "float")])
    raw = raw.withColumns({c: F.col(c).cast("bigint") for c in amounts})
    fixed = PR.repair_cost(raw).withColumn("cpt_c", F.col("cpt_fixed_c")).drop("cpt_fixed_c", "cost_repaired")
    return PR.with_week(fixed)


def refresh_from_extracts(spark: SparkSession, pattern: str, out_dir: str, fmt: str = "parquet",
                          window: P.WindowParams | None = None, unique_ids: bool = True) -> dict[str, str]:
    """From extract files to the ten summary tables: bring the prepared fact up to date (only the
    months of new, changed and removed files are rewritten), derive the clean window from the files
    (or take ``window``), write and check the tables, publish."""
    folder = f"{out_dir.rstrip('/')}/prepared"
    refresh_months(spark, pattern, folder, extracts_fact)
    ctx = FrameContext(spark, read_prepared(spark, folder).drop("booking_month"), window)
    return publish(ctx, out_dir, fmt, unique_ids)


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    ctx = context(spark, sf_dir)
    clean = ctx.clean
    rules = D.assert_unique(D.rules_union(spark), "coupon_code")
    exposure = G.package_exposure(clean)
    return {
        "campaign_scorecard": C.campaign_scorecard(clean, rules),
        "mov_compliance": C.mov_compliance(clean, rules),
        "upper_limit_breach": C.upper_limit_breach(clean, rules),
        "stacking_curve": C.stacking_curve(clean),
        "depth_curve": C.depth_curve(clean, D.depth_tiers(spark)),
        "segment_mix": G.segment_mix(clean),
        "segment_channel": G.segment_channel(clean),
        "stacking_risk": M.stacking_risk(D.price_actions(spark), exposure),
        "daily_scorecard": G.daily_scorecard(clean),
    }
