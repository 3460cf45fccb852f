"""Registrations for data-quality keys and for the expression-level operators.

An expression operator (a filter or derived column) is checked through a small aggregate
of its output over the whole fact, which exercises every row without shipping it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from ..operators import prepare as PR
from ..operators import quality as Q
from ..operators import rollups as R
from ..sources.tables import read_table, spread_scan
from .context import context
from .registry import register


def _c(spark, sf):
    return context(spark, sf)


def _count() -> F.Column:
    return F.count(F.lit(1)).alias("rows")


# -- expression operators -----------------------------------------------------------------

def q_clean_window(s, d):
    ctx = _c(s, d)
    cut = PR.clean_window(ctx.bookings, *ctx.window)
    return cut.groupBy(F.trunc("booking_date", "MM").alias("booking_month")).agg(
        _count(), F.min("booking_date").alias("first_day"), F.max("booking_date").alias("last_day"))


def q_repair_cost(s, d):
    fixed = PR.repair_cost(_c(s, d).bookings)
    return fixed.agg(
        _count(), X.count_when(F.col("cost_repaired")).alias("rows_repaired"),
        X.count_when(F.col("cpt_fixed_c").isNull()).alias("rows_unrepairable"),
        X.sum0("cpt_fixed_c").alias("cost_fixed_sum"),
        X.count_when(F.col("cpt_fixed_c") != F.col("cpt_c")).alias("mismatches"))


def q_week_start(s, d):
    wk = PR.with_week(_c(s, d).bookings.drop("week_start"))
    return wk.groupBy("week_start").agg(_count(), F.min("booking_date").alias("first_day"),
                                        F.max("booking_date").alias("last_day"))


def q_discount_kinds(s, d):
    k = PR.discount_kinds(_c(s, d).bookings, nonzero_rule=True)
    return k.groupBy("n_disc_types", "n_disc_bucket").agg(_count())


def q_has_coupon(s, d):
    return (_c(s, d).bookings.groupBy(X.has_coupon().alias("has_coupon"))
            .agg(_count(), X.sum0("coupon_c").alias("coupon_sum")))


def q_depth_tier(s, d):
    return _c(s, d).settled.groupBy(X.depth_tier("n_disc").alias("depth_tier")).agg(_count())


def q_bucket_top_n(s, d):
    dims = {"package_bucket": "package", "city_bucket": "city", "coupon_bucket": "coupon"}
    sets = _c(s, d).bucketed().groupingSets([[c] for c in dims], *dims).agg(
        _count(), *[F.grouping(c).alias(f"no_{c}") for c in dims])  # one scan for all three
    pick = [(F.col(f"no_{c}") == 0, name, F.col(c)) for c, name in dims.items()]
    return sets.select(F.coalesce(*[F.when(own, F.lit(name)) for own, name, _ in pick]).alias("dimension"),
                       F.coalesce(*[F.when(own, c) for own, _, c in pick]).alias("bucket"), "rows")


def q_bucket_min_count(s, d):
    c = _c(s, d).clean
    return PR.min_count_rollup(c, "package_code", P.MIN_PACKAGE_ROWS, "package_bucket", {"rows": F.count(F.lit(1))})


def q_combo_flag(s, d):
    return _c(s, d).bookings.groupBy(X.is_combo().alias("is_combo")).agg(_count())


def q_before_clean_start_cut(s, d):
    ctx = _c(s, d)
    cut = PR.from_clean_start(ctx.settled, *ctx.window)
    return cut.groupBy("is_partial").agg(_count(), F.min("booking_date").alias("first_day"),
                                         F.max("booking_date").alias("last_day"))


def q_net_and_margin(s, d):
    nm = PR.net_and_margin(_c(s, d).bookings)
    return nm.agg(_count(), X.count_when(F.col("net_calc_c") != F.col("net_c")).alias("net_mismatch"),
                  X.count_when(F.col("gm_calc_c") != F.col("gm_c")).alias("gm_mismatch"),
                  X.count_when(F.col("is_negative_gm")).alias("negative_gm"),
                  X.count_when(F.col("is_3plus")).alias("stacked_3plus"))


def q_complete_weeks(s, d):
    return PR.complete_weeks(_c(s, d).settled).select("week_start").distinct()


def q_suppress_small_n(s, d):
    st = R.weekly_stack(_c(s, d).settled).select("week_start", "n_disc_types", "tier", "bookings", "gm_pct")
    return PR.suppress_small_n(st, "bookings", "gm_pct")


def q_bookings_scope(s, d):
    c = _c(s, d).clean
    scopes = {"all": F.lit(True), "vip_gold": F.col("customer_category") == "vip gold",
              "sales": F.col("booked_by") == "Sales", "coupon": X.has_coupon()}
    one = c.agg(*[X.count_when(p).alias(f"n_{k}") for k, p in scopes.items()],
                *[X.sum0(F.when(p, F.col("gm_c"))).alias(f"gm_{k}") for k, p in scopes.items()])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(k).alias("scope"), F.col(f"n_{k}").alias("rows"), F.col(f"gm_{k}").alias("gm_sum")) for k in scopes])))


def q_currency_view(s, d):
    wf = R.weekly_waterfall(_c(s, d).clean).select("week_start", "offer_sum", "net_sum", "gm_sum")
    return PR.currency_view(wf, ["offer_sum", "net_sum", "gm_sum"], P.FX_RATE)


# -- quality -------------------------------------------------------------------------------

def q_waterfall_reconcile(s, d):
    return Q.waterfall_reconcile(R.weekly_waterfall(_c(s, d).clean))


def rollup_totals(published: dict[str, DataFrame]) -> DataFrame:
    """Total complete-week GM of each published weekly table, read from the tables themselves."""
    parts = [PR.complete_weeks(t).agg(X.sum0("gm_sum").alias("gm_total")).select(F.lit(name).alias("rollup"), "gm_total")
             for name, t in published.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def published_rollups(settled: DataFrame) -> dict[str, DataFrame]:
    """The weekly tables whose totals must agree, as their rollup functions publish them. Each is
    computed on its own (five scans): the check is worth nothing on a shared intermediate."""
    return {name: getattr(R, name)(settled) for name in (
        "weekly_waterfall", "weekly_stack", "weekly_coupon", "weekly_segment", "weekly_market_sku")}


def q_rollup_totals_agree(s, d):
    return Q.rollup_totals_agree(rollup_totals(published_rollups(_c(s, d).settled)))


def q_null_margin_guard(s, d):
    ctx = _c(s, d)  # unsettled rows are still in: the window cut of all bookings
    return Q.null_margin_guard(PR.clean_window(ctx.bookings, *ctx.window))


def banned_hashes(spark) -> DataFrame:
    """Hashed list, built from literals so that Spark knows its size and broadcasts it by its own
    threshold; a list read from a large table would join by sort-merge."""
    words = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in P.BANNED_WORDS])).alias("word"))
    return words.select(F.sha2(F.lower("word"), 256).alias("token_hash"))


def q_banned_tokens(s, d):
    docs = spread_scan(read_table(s, d, "documents", ["doc_id", "text"]), "doc_id")
    return Q.banned_tokens(docs, banned_hashes(s), pattern=P.TOKEN_PATTERN)


def q_duplicate_ids(s, d):
    return PR.duplicate_ids(_c(s, d).bookings)


def q_extract_disjoint(s, d):
    return PR.extract_overlap(_c(s, d).bookings)


def q_union_extracts(s, d):
    """Three extracts cut by collection year (one lacks the zone column), unioned by name."""
    b = _c(s, d).bookings
    y = F.year("collection_date")
    e1 = b.filter(y < 1997).withColumn("extract", F.lit("early"))
    e2 = b.filter(y.between(1997, 1999)).withColumn("extract", F.lit("middle")).drop("zone")
    e3 = b.filter(y >= 2000).withColumn("extract", F.lit("late"))
    u = PR.union_extracts([e1, e2, e3])
    return u.groupBy("extract").agg(_count(), X.count_when(F.col("zone").isNull()).alias("rows_missing_zone"),
                                    X.sum0("gm_c").alias("gm_sum"))


def extract_rows(fact: DataFrame) -> DataFrame:
    """The fact as raw extracts. They are cut where the fact's files are, by few months each: rows
    keep their place, so writing them shuffles nothing."""
    return fact.drop("is_partial", "week_start", "cpt_c").withColumns({
        "package_code": F.concat(F.lit(" "), "package_code", F.lit("  ")),
        "gm_c": F.coalesce(F.col("gm_c").cast("double"), F.lit(float("nan")))})


def q_extracts_refresh(s, d):
    """The fact written out as extracts (padded keys, NaN margins, no cost column) and read back
    through the extract path: the waterfall over repaired costs."""
    from ..sources.bookings import dataset_version
    from ..session import checkpoint_dir, exists
    from .context import FrameContext
    from .refresh import extracts_fact
    path = f"{checkpoint_dir(s)}/ledgerlens/extracts/{dataset_version(s, d)}"
    if not exists(s, path + "/_SUCCESS"):
        extract_rows(_c(s, d).bookings).write.mode("overwrite").parquet(path)
    return R.weekly_waterfall(FrameContext(s, extracts_fact(s, path)).clean)


def q_template_waterfall(s, d):
    """The fact written out as booking templates (CSV) with some unreadable lines, read back with
    these set aside and mapped to the fact: the weekly waterfall of all bookings, settled or not."""
    from ..session import checkpoint_dir, exists
    from ..sources.bookings import dataset_version
    from ..sources.files import read_template_checked, template_to_fact
    path = f"{checkpoint_dir(s)}/ledgerlens/templates/{dataset_version(s, d)}"
    if not exists(s, path + "/good/_SUCCESS"):
        b = _c(s, d).bookings
        money = {"offer_price": "offer_c", "campaign_discount": "special_c", "member_discount": "vip_c",
                 "coupon_discount": "coupon_c", "wallet_credit": "redcash_c", "gift_card": "giftcard_c",
                 "net_revenue": "net_c", "cost": "cpt_c"}
        rows = b.select("booking_date", "market", "sku", F.col("customer_category").alias("tier"), F.col("booked_by").alias("channel"),
                        F.col("booking_flag").alias("flag"), F.coalesce("coupon_code", F.lit(" ")).alias("coupon"),
                        *[(F.col(c).cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias(a) for a, c in money.items()], "booking_id")
        bad = rows.where("booking_id % 1000 = 7").withColumn("offer_price", F.lit("n/a")).withColumn("booking_date", F.lit("soon"))
        for name, part in (("bad", bad), ("good", rows)):  # the unreadable lines stand in files of their own
            part.drop("booking_id").write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
    df = read_template_checked(s, [f"{path}/good", f"{path}/bad"], f"{path}/unreadable")
    return R.rollup(template_to_fact(df), ["week_start"])


for _key, _fn in {
    "extracts_refresh": q_extracts_refresh, "template_waterfall": q_template_waterfall,
    "clean_window": q_clean_window, "repair_cost": q_repair_cost, "week_start": q_week_start,
    "discount_kinds": q_discount_kinds, "has_coupon": q_has_coupon, "coupon_depth_tier": q_depth_tier,
    "bucket_top_n": q_bucket_top_n, "bucket_min_count": q_bucket_min_count, "combo_flag": q_combo_flag,
    "before_clean_start_cut": q_before_clean_start_cut, "net_and_margin": q_net_and_margin,
    "complete_weeks": q_complete_weeks, "suppress_small_n": q_suppress_small_n, "bookings_scope": q_bookings_scope,
    "currency_view": q_currency_view, "waterfall_reconcile": q_waterfall_reconcile,
    "rollup_totals_agree": q_rollup_totals_agree, "null_margin_guard": q_null_margin_guard,
    "banned_tokens": q_banned_tokens, "duplicate_ids": q_duplicate_ids, "extract_disjoint": q_extract_disjoint,
    "union_extracts": q_union_extracts,
}.items():
    register(_key)(_fn)
