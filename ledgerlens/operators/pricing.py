"""Pricing and policy analytics.

Event joins: bookings are first aggregated to a cell table (day or week x sku x market), then
joined to the event list by week bins (``intervals``): an equality on (sku, market, week) with the
exact dates as a residual, so raw bookings are never paired. No side is hinted: event and promo
lists may grow, and Spark broadcasts what its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from . import intervals as I
from . import prepare as PR
from .ranking import percent_ranks

IMPACT_WINDOW_DAYS = 28


def _round6(c: Column) -> Column:
    """Publish log-based values to 1e-6 (last-bit libm differences stay invisible)."""
    return F.floor(c * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def daily_cells(clean: DataFrame) -> DataFrame:
    return clean.groupBy("booking_date", "sku", "market").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("gm_c").alias("gm_sum"), X.sum0("net_c").alias("revenue_sum"),
        X.sum0("offer_c").alias("offer_sum"))


def weekly_panel(settled: DataFrame) -> DataFrame:
    """Complete-week bookings per (week, market, sku)."""
    return (PR.complete_weeks(settled).groupBy("week_start", "market", "sku")
            .agg(F.count(F.lit(1)).alias("bookings")))


def _executed(events_m: DataFrame) -> DataFrame:
    return events_m.filter(F.col("change_week").isNotNull())


def _event_days(events: DataFrame, cells: DataFrame, days: int, how: str) -> DataFrame:
    """Events with the daily cells of their sku and market inside [d - w, d + w - 1]."""
    windows = I.by_week(events, F.date_sub("change_week", days), F.date_add("change_week", days - 1))
    own = cells.withColumnsRenamed({"sku": "c_sku", "market": "c_market"})
    return I.in_windows(windows, own, {"sku": "c_sku", "market": "c_market"}, "booking_date", how)


def event_window_range(clean: DataFrame, events_m: DataFrame, days: int = IMPACT_WINDOW_DAYS,
                       cells: DataFrame | None = None) -> DataFrame:
    """Non-equi join: each executed event x market with the days inside [d - w, d + w - 1].
    ``cells`` is ``daily_cells(clean)`` when the caller already holds it (cached)."""
    j = _event_days(_executed(events_m).select("event_id", "sku", "market", "change_week"),
                    daily_cells(clean) if cells is None else cells, days, "inner")
    return j.select("event_id", "market", "booking_date",
                    F.when(F.col("booking_date") < F.col("change_week"), F.lit("pre")).otherwise(F.lit("post"))
                    .alias("side"), "bookings", "gm_sum", "revenue_sum", "offer_sum")


def price_event_daily(clean: DataFrame, events_m: DataFrame, days: int = IMPACT_WINDOW_DAYS,
                      cells: DataFrame | None = None) -> DataFrame:
    """Every event (executed or not) LEFT JOIN the daily cells on exact sku and market
    inside the window; unmatched events are kept and flagged."""
    j = _event_days(events_m.select("event_id", "sku", "market", "change_week", "status"),
                    daily_cells(clean) if cells is None else cells, days, "left")
    return (j.groupBy("event_id", "market", "status").agg(
        F.count("booking_date").alias("matched_days"), F.min("booking_date").alias("first_day"),
        F.max("booking_date").alias("last_day"))
        .withColumn("matched", F.col("matched_days") > 0))


def price_event_impact(clean: DataFrame, events_m: DataFrame, rules: DataFrame | None = None,
                       days: int = IMPACT_WINDOW_DAYS, cells: DataFrame | None = None) -> DataFrame:
    """Per executed event x market: sums before [d-w, d-1] and after [d, d+w-1]; gm_pct and
    ASP deltas; annotated with coupons created in the same window when ``rules`` is given
    (a coincident coupon change contaminates the read)."""
    r = event_window_range(clean, events_m, days, cells)
    pre, post = F.col("side") == "pre", F.col("side") == "post"

    def s(c, cond):
        return X.sum0(F.when(cond, F.col(c)))
    g = r.groupBy("event_id", "market").agg(
        s("bookings", pre).alias("pre_bookings"), s("bookings", post).alias("post_bookings"),
        s("gm_sum", pre).alias("pre_gm"), s("gm_sum", post).alias("post_gm"),
        s("revenue_sum", pre).alias("pre_revenue"), s("revenue_sum", post).alias("post_revenue"),
        s("offer_sum", pre).alias("pre_offer"), s("offer_sum", post).alias("post_offer"))
    g = (g.withColumn("pre_gm_pct", X.ratio_pct("pre_gm", "pre_revenue"))
         .withColumn("post_gm_pct", X.ratio_pct("post_gm", "post_revenue"))
         .withColumn("pre_asp", X.ratio("pre_offer", "pre_bookings"))
         .withColumn("post_asp", X.ratio("post_offer", "post_bookings")))
    g = (g.withColumn("gm_pct_delta", F.col("post_gm_pct") - F.col("pre_gm_pct"))
         .withColumn("asp_delta", F.col("post_asp") - F.col("pre_asp")))
    if rules is not None:
        g = g.join(concurrent_coupon_change(events_m, rules, days), ["event_id", "market"], "left")
    return g


def arc_elasticity(impact: DataFrame, events_m: DataFrame) -> DataFrame:
    ev = _executed(events_m).select("event_id", "market", "pct_change")
    j = impact.join(ev, ["event_id", "market"])
    vol = X.ratio_pct(F.col("post_bookings") - F.col("pre_bookings"), "pre_bookings")
    return j.select("event_id", "market", "pct_change", "pre_bookings", "post_bookings", vol.alias("volume_pct"),
                    (vol / F.when(F.col("pct_change") != 0, F.col("pct_change"))).alias("arc_elasticity"))


def _panel_weeks(events: DataFrame, panel: DataFrame, weeks: int, keys: dict[str, str]) -> DataFrame:
    """Events with the panel's weeks from ``weeks`` before to ``weeks`` - 1 after the change week."""
    span = 7 * weeks
    windows = I.by_week(events, F.date_sub("change_week", span), F.date_add("change_week", span - 7))
    own = panel.withColumnsRenamed({"sku": "p_sku", "market": "p_market"})
    return I.in_windows(windows, own, keys, "week_start")


def _market_promos(promos: DataFrame) -> DataFrame:
    return promos.filter(F.col("scope") == "market").select(
        F.col("market").alias("p_market"), F.col("week_start").alias("p_week"))


def _arm_totals(panel: DataFrame, events_m: DataFrame, weeks: int) -> DataFrame:
    """Tpre/Tpost/Cpre/Cpost per executed event x treated market. Each event-market yields
    two arms (treated, control); arms join the weekly panel on sku, market and a week range."""
    ev = _executed(events_m)
    arms = ev.select("event_id", "sku", "market", "change_week",
                     F.explode(F.array(
                         F.struct(F.lit("T").alias("arm"), F.col("market").alias("arm_market")),
                         F.struct(F.lit("C").alias("arm"), F.col("control_market").alias("arm_market")))).alias("a"))
    arms = arms.select("event_id", "sku", "market", "change_week", "a.arm", "a.arm_market")
    j = _panel_weeks(arms, panel, weeks, {"sku": "p_sku", "arm_market": "p_market"})
    is_post = F.col("week_start") >= F.col("change_week")

    def tot(arm, post):
        return X.sum0(F.when((F.col("arm") == arm) & (is_post if post else ~is_post), F.col("bookings")))
    return j.groupBy("event_id", "market").agg(
        tot("T", False).alias("t_pre"), tot("T", True).alias("t_post"),
        tot("C", False).alias("c_pre"), tot("C", True).alias("c_post"))


def confounder_overlap(events_m: DataFrame, promos: DataFrame, weeks: int = P.DID_WINDOW_WEEKS) -> DataFrame:
    """An event is confounded when a market-scope promo hits its treated market inside the
    post window; global promos hit both arms and do not flag."""
    ev = _executed(events_m)
    windows = I.by_week(ev.select("event_id", "market", "change_week"), F.col("change_week"),
                        F.date_add("change_week", 7 * weeks - 7))
    j = I.in_windows(windows, _market_promos(promos), {"market": "p_market"}, "p_week", "left")
    return (j.groupBy("event_id", "market").agg(F.count("p_week").alias("promos_in_post"))
            .withColumn("confounded", F.col("promos_in_post") > 0))


def control_contamination(events_m: DataFrame, promos: DataFrame, weeks: int = P.DID_WINDOW_WEEKS) -> DataFrame:
    """Control market itself treated (another executed event on the same sku) or pushed by
    a market promo anywhere in the pre+post window."""
    ev = _executed(events_m)
    windows = I.by_week(ev.select("event_id", "sku", "market", "control_market", "change_week"),
                        F.date_sub("change_week", 7 * weeks), F.date_add("change_week", 7 * weeks - 7))
    other = ev.select(F.col("event_id").alias("o_id"), F.col("sku").alias("o_sku"), F.col("market").alias("o_market"),
                      F.col("change_week").alias("o_week"))
    treated = (I.in_windows(windows, other, {"sku": "o_sku", "control_market": "o_market"}, "o_week", "left")
               .groupBy("event_id", "market").agg(F.count("o_id").alias("control_events")))
    pushed = (I.in_windows(windows, _market_promos(promos), {"control_market": "p_market"}, "p_week", "left")
              .groupBy("event_id", "market").agg(F.count("p_week").alias("control_promos")))
    out = treated.join(pushed, ["event_id", "market"])
    return out.withColumn("contaminated", (F.col("control_events") > 0) | (F.col("control_promos") > 0))


def did_elasticity(settled: DataFrame, events_m: DataFrame, promos: DataFrame,
                   weeks: int = P.DID_WINDOW_WEEKS, z: float = P.Z90, panel: DataFrame | None = None) -> DataFrame:
    """Difference-in-differences elasticity with a 90 % CI, one row per executed event x
    treated market; null when any window total is 0. ``panel`` is ``weekly_panel(settled)``
    when the caller already holds it (e.g. cached once per dataset)."""
    return did_from_panel(weekly_panel(settled) if panel is None else panel, events_m, promos, weeks, z)


def did_from_panel(panel: DataFrame, events_m: DataFrame, promos: DataFrame,
                   weeks: int = P.DID_WINDOW_WEEKS, z: float = P.Z90) -> DataFrame:
    """DiD on a complete-week panel (week_start, market, sku, bookings).

    e = [ln(Tpost/Tpre) - ln(Cpost/Cpre)] / ln(1+p) on window totals of the treated and
    control cells; SE = sqrt(1/Tpre + 1/Tpost + 1/Cpre + 1/Cpost) / |ln(1+p)|; CI = e +- z SE.
    Flags: ``confounded`` (market promo on the treated market in the post window) and
    ``contaminated`` (control market treated or pushed inside the window)."""
    t = _arm_totals(panel, events_m, weeks)
    ev = _executed(events_m).select("event_id", "market", "pct_change", "control_market")
    j = (t.join(ev, ["event_id", "market"])
         .join(confounder_overlap(events_m, promos, weeks), ["event_id", "market"])
         .join(control_contamination(events_m, promos, weeks).select("event_id", "market", "contaminated"),
               ["event_id", "market"]))
    ok = (F.col("t_pre") > 0) & (F.col("t_post") > 0) & (F.col("c_pre") > 0) & (F.col("c_post") > 0)
    lnp = F.log(F.lit(1.0) + F.col("pct_change") / F.lit(100.0))
    e = (F.log(X.ratio("t_post", "t_pre")) - F.log(X.ratio("c_post", "c_pre"))) / F.when(lnp != 0, lnp)
    inv = [X.ratio(F.lit(1), c) for c in ("t_pre", "t_post", "c_pre", "c_post")]
    se = F.sqrt(inv[0] + inv[1] + inv[2] + inv[3]) / F.when(lnp != 0, F.abs(lnp))
    return j.select(
        "event_id", "market", "control_market", "pct_change", "t_pre", "t_post", "c_pre", "c_post",
        _round6(F.when(ok, e)).alias("elasticity"), _round6(F.when(ok, se)).alias("se"),
        _round6(F.when(ok, e - F.lit(z) * se)).alias("ci_lo"), _round6(F.when(ok, e + F.lit(z) * se)).alias("ci_hi"),
        "confounded", "contaminated")


def did_pairing(settled: DataFrame, events_m: DataFrame, weeks: int = P.DID_WINDOW_WEEKS,
                panel: DataFrame | None = None) -> DataFrame:
    """Treated cell joined to the control-market cell on sku x week, inside the window."""
    panel = weekly_panel(settled) if panel is None else panel
    ev = _executed(events_m).select("event_id", "sku", "market", "control_market", "change_week")
    tr = _panel_weeks(ev, panel, weeks, {"sku": "p_sku", "market": "p_market"})
    tr = tr.select("event_id", "sku", "market", "control_market", "change_week", "week_start",
                   F.col("bookings").alias("treated_bookings"))
    ctl = panel.select(F.col("sku").alias("c_sku"), F.col("market").alias("c_market"),
                       F.col("week_start").alias("c_week"), F.col("bookings").alias("control_bookings"))
    j = tr.join(ctl, (tr.sku == ctl.c_sku) & (tr.control_market == ctl.c_market) & (tr.week_start == ctl.c_week),
                "left")
    return j.select("event_id", "market", "week_start",
                    (F.datediff("week_start", "change_week") / F.lit(7)).cast("int").alias("rel_week"),
                    "treated_bookings", "control_bookings")


def concurrent_coupon_change(events_m: DataFrame, rules: DataFrame, days: int = IMPACT_WINDOW_DAYS) -> DataFrame:
    """Coupons created inside each executed event's window (sorted, comma-joined). Each event
    is exploded to the days of its window, so the join is an equality on the day."""
    day = F.explode(F.sequence(F.date_sub("change_week", days), F.date_add("change_week", days - 1)))
    ev = _executed(events_m).select("event_id", "market", day.alias("create_date"))
    r = rules.filter(F.col("create_date").isNotNull()).select("coupon_code", "create_date")
    j = ev.join(r, "create_date", "left")
    return j.groupBy("event_id", "market").agg(
        F.count("coupon_code").alias("coupons_created"),
        F.array_join(F.array_sort(F.collect_set("coupon_code")), ",").alias("coupon_codes"))


def list_prices(part: DataFrame) -> DataFrame:
    """List price per sku (p_type) in cents: the highest retail price of its parts."""
    return part.groupBy(F.col("p_type").alias("sku")).agg(
        F.floor(F.max("p_retailprice") * 100 + F.lit(0.5)).cast("bigint").alias("list_c"))


def price_event_rows(part: DataFrame, events_m: DataFrame, market_mult: DataFrame) -> DataFrame:
    """One row per event x treated market: old price = list x market multiplier, new price,
    change, percent; change date null when the event was not executed."""
    j = events_m.join(list_prices(part), "sku").join(market_mult, "market")
    old = F.floor(F.col("list_c") * F.col("market_mult") + F.lit(0.5)).cast("bigint")
    out = j.withColumn("old_price_c", old)
    new = F.floor(F.col("old_price_c") * (F.lit(100) + F.col("pct_change")) / F.lit(100.0) + F.lit(0.5)).cast("bigint")
    return out.select("event_id", "sku", "market", "old_price_c", new.alias("new_price_c"),
                      (new - F.col("old_price_c")).alias("price_change_c"), "pct_change", "status",
                      F.col("change_week").alias("change_date"), "control_market")


def flat_volume_impact(settled: DataFrame, part: DataFrame, events_m: DataFrame, market_mult: DataFrame,
                       weeks: int = P.DID_WINDOW_WEEKS, panel: DataFrame | None = None) -> DataFrame:
    """(new - old price) x pre-window weekly bookings for each executed event x market."""
    rows = price_event_rows(part, _executed(events_m), market_mult)
    panel = weekly_panel(settled) if panel is None else panel
    t = _arm_totals(panel, events_m, weeks).select("event_id", "market", "t_pre")
    j = rows.join(t, ["event_id", "market"], "left")
    wk = F.coalesce(F.col("t_pre"), F.lit(0)) / F.lit(float(weeks))
    out = j.select("event_id", "market", "old_price_c", "new_price_c", "price_change_c", "pct_change",
                   wk.alias("weekly_bookings"), (F.col("price_change_c") * wk).alias("weekly_revenue_impact_c"))
    # total over the event list: exact integer sum, divided once (order-independent)
    total = j.select(F.sum(F.col("price_change_c") * F.coalesce(F.col("t_pre"), F.lit(0)))).scalar()
    return out.withColumn("total_weekly_revenue_impact_c", total / F.lit(float(weeks)))


def competitor_gap(part: DataFrame, competitors_wide: DataFrame, events: DataFrame) -> DataFrame:
    """Unpivot competitor prices; gap vs our list price; warn when a raise is planned on a
    sku where a competitor is already cheaper."""
    comps = [c for c in competitors_wide.columns if c != "sku"]
    long = competitors_wide.unpivot(["sku"], comps, "competitor", "mult")
    lp = list_prices(part)
    raise_planned = events.groupBy("sku").agg((F.max((F.col("pct_change") > 0).cast("int")) > 0).alias("raise_planned"))
    j = lp.join(long, "sku").join(raise_planned, "sku", "left")
    comp = F.floor(F.col("list_c") * F.col("mult") + F.lit(0.5)).cast("bigint")
    planned = F.coalesce(F.col("raise_planned"), F.lit(False))
    return j.select("sku", "competitor", "list_c", comp.alias("competitor_price_c"),
                    X.ratio_pct(comp - F.col("list_c"), "list_c").alias("gap_pct"),
                    planned.alias("raise_planned"), (planned & (comp < F.col("list_c"))).alias("warn"))


def competitor_gap_by_city(clean: DataFrame, part: DataFrame, competitors_wide: DataFrame,
                           events_m: DataFrame) -> DataFrame:
    """Per sku, city and competitor: our mean price among the city's bookings, the competitor's
    price, the gap, and a warning where a raise is planned for the sku in the city's market while
    the competitor is already below us there."""
    comps = [c for c in competitors_wide.columns if c != "sku"]
    long = competitors_wide.unpivot(["sku"], comps, "competitor", "mult")
    own = clean.groupBy("sku", "city", "market").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("offer_c").alias("offer_sum"))
    planned = events_m.groupBy("sku", "market").agg((F.max(F.col("pct_change")) > 0).alias("raise_planned"))
    j = own.join(list_prices(part).join(long, "sku"), "sku").join(planned, ["sku", "market"], "left")
    price = F.col("offer_sum") / F.col("bookings")
    theirs = F.floor(F.col("list_c") * F.col("mult") + F.lit(0.5)).cast("bigint")
    raising = F.coalesce(F.col("raise_planned"), F.lit(False))
    return j.select("sku", "city", "market", "competitor", "bookings", price.alias("price_c"),
                    theirs.alias("competitor_price_c"), X.ratio_pct(theirs - price, price).alias("gap_pct"),
                    raising.alias("raise_planned"), (raising & (theirs < price)).alias("warn"))


def price_action_exposure(actions: DataFrame, exposure: DataFrame) -> DataFrame:
    """Price actions LEFT JOIN package exposure; unmatched actions kept and flagged."""
    e = exposure.withColumn("_m", F.lit(True))
    j = actions.join(e, "package_code", "left")
    return j.withColumn("has_exposure", F.coalesce(F.col("_m"), F.lit(False))).drop("_m")


def stacking_risk(actions: DataFrame, exposure: DataFrame) -> DataFrame:
    j = price_action_exposure(actions, exposure)
    flag = X.risk_flag("coupon_penetration", "avg_total_disc_pct", "actual_price_pct_change")
    return (j.withColumn("stacking_risk", flag)
            .withColumn("risk_attention", F.col("stacking_risk").startswith("HIGH")
                        | F.col("stacking_risk").startswith("MEDIUM")))


def risk_driver(risk: DataFrame) -> DataFrame:
    """HIGH-risk packages grouped by their top coupon."""
    high = risk.filter(F.col("stacking_risk").startswith("HIGH"))
    return high.groupBy("top_coupon").agg(F.count(F.lit(1)).alias("high_risk_packages"),
                                          X.sum0("weekly_gm_delta_c").alias("weekly_gm_delta_c"))


def breakeven_elasticity(clean: DataFrame) -> DataFrame:
    """-P / (P - C) from mean price and cost per package; null when P <= C."""
    g = clean.groupBy("package_code").agg(F.count(F.lit(1)).alias("bookings"), X.sum0("offer_c").alias("offer_sum"),
                                          X.sum0("cpt_c").alias("cost_sum"))
    margin = F.col("offer_sum") - F.col("cost_sum")
    return g.withColumn("breakeven_elasticity",
                        F.when(margin > 0, -F.col("offer_sum") / margin))


LOSS_RATES = [0.0, 0.05, 0.1, 0.2]
CAPS = [1, 2, 3]


def cap_scenarios(settled: DataFrame, caps=CAPS, loss_rates=LOSS_RATES) -> DataFrame:
    """What-if: cap the number of stacked discount kinds at n with a loss rate r.

    affected = bookings with more kinds than the cap; gross = their discount above what the
    cap-level average discount rate would give; at_risk = their GM; net = gross - r *
    (at_risk + gross); break-even r = gross / (at_risk + gross). Levels are aggregated
    first (one row per kind count), each level fans out to the caps up to it."""
    full = PR.complete_weeks(settled)
    disc = sum(F.col(c) for c in P.DISCOUNT_KINDS)
    lv = full.groupBy(F.col("n_disc").alias("level")).agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("offer_c").alias("offer"), X.sum0(disc).alias("disc"),
        X.sum0("gm_c").alias("gm"))
    cap_arr = F.array(*[F.lit(c) for c in caps])
    fan = lv.select("*", F.explode(F.filter(cap_arr, lambda c: c <= F.col("level"))).alias("cap"))
    above, at_cap = F.col("level") > F.col("cap"), F.col("level") == F.col("cap")
    aff = fan.groupBy("cap").agg(
        F.sum(F.when(above, F.col("bookings"))).alias("affected_bookings"),
        F.sum(F.when(above, F.col("offer"))).alias("offer_aff"), F.sum(F.when(above, F.col("disc"))).alias("disc_aff"),
        F.sum(F.when(above, F.col("gm"))).alias("gm_aff"), F.max(F.when(at_cap, F.col("offer"))).alias("offer_cap"),
        F.max(F.when(at_cap, F.col("disc"))).alias("disc_cap")).where("affected_bookings is not null")
    j = aff
    gross = F.col("disc_aff") - (F.col("disc_cap") / F.col("offer_cap")) * F.col("offer_aff")
    j = j.withColumn("gross_recovered", gross).withColumn("at_risk_gm", F.col("gm_aff"))
    j = j.withColumn("loss_rate", F.explode(F.array(*[F.lit(float(r)) for r in loss_rates])))
    base = F.col("at_risk_gm") + F.col("gross_recovered")
    return j.select("cap", "loss_rate", "affected_bookings", "gross_recovered", "at_risk_gm",
                    (F.col("gross_recovered") - F.col("loss_rate") * base).alias("net_change"),
                    (F.col("gross_recovered") / F.when(base != 0, base)).alias("break_even_loss_rate"))


def coupon_health(clean: DataFrame, healthy: float = 0.66, watch: float = 0.33) -> DataFrame:
    """Composite coupon score: mean percent-rank over revenue, volume, AOV, repeat share,
    discount efficiency (higher is better) and concentration in one package (lower is
    better). Measures come from one aggregate at coupon x package rolled up to coupons; the
    ranks are distributed over the coupon aggregate (one row per code)."""
    c = clean.filter(F.col("coupon_code").isNotNull())
    pairs = c.groupBy("coupon_code", "package_code").agg(
        F.count(F.lit(1)).alias("bookings"), X.sum0("net_c").alias("revenue"), X.sum0("gm_c").alias("gm"),
        X.sum0("offer_c").alias("offer"), X.sum0("coupon_c").alias("coupon_sum"),
        X.count_when(F.col("booking_flag") == P.REPEAT).alias("repeat_n"))
    m = pairs.groupBy("coupon_code").agg(
        *[F.sum(k).alias(k) for k in ("revenue", "gm", "offer", "coupon_sum", "repeat_n")],
        F.max("bookings").alias("top_package_n"), F.sum("bookings").alias("bookings")).select(
        "coupon_code", "bookings", "revenue",
        (F.col("offer") / F.col("bookings")).alias("aov"),
        X.ratio("repeat_n", "bookings").alias("repeat_share"),
        X.ratio("top_package_n", "bookings").alias("concentration"),
        X.ratio("gm", "coupon_sum").alias("discount_efficiency"))
    better_up = {"revenue": True, "bookings": True, "aov": True, "repeat_share": True, "discount_efficiency": True,
                 "concentration": False}
    out = percent_ranks(m, ["coupon_code"], better_up)
    score = sum(F.col(f"{k}_rank") for k in better_up) / F.lit(float(len(better_up)))
    out = out.withColumn("health_score", _round6(score)).select(*m.columns, "health_score")
    return out.withColumn("health", F.when(F.col("health_score") >= healthy, F.lit("healthy"))
                          .when(F.col("health_score") >= watch, F.lit("watch")).otherwise(F.lit("at risk")))


def elastic_multiplier(cells: DataFrame, events_m: DataFrame, elasticity_col: str = "true_elasticity",
                       carry: tuple[str, ...] = ()) -> DataFrame:
    """Price and volume multipliers of each (week_start, market, sku) cell from the executed
    events active in it (change week <= week): price = prod(1+p), volume = prod((1+p)^e).
    Products are exp(running sum of ln) along the weeks of a market and sku, events standing
    before the cells of their week: no cell is paired with every event before it. Cells without
    events get 1. An active event with an unknown elasticity makes the volume multiplier unknown
    (null) rather than silently neutral. ``carry`` names cell columns kept alongside (they must be
    determined by the cell key)."""
    growth = F.lit(1.0) + F.col("pct_change") / F.lit(100.0)
    keys = ["week_start", "market", "sku"]
    steps = _executed(events_m).groupBy(F.col("change_week").alias("week_start"), "market", "sku").agg(
        F.count(F.lit(1)).alias("_events"), F.sum(F.log(growth)).alias("_price"),
        F.sum(F.col(elasticity_col) * F.log(growth)).alias("_volume"),
        F.count_if(F.col(elasticity_col).isNull()).alias("_unknown"))
    line = cells.select(*keys, *carry, F.lit(True).alias("_cell")).unionByName(steps, allowMissingColumns=True)
    along = (Window.partitionBy("market", "sku").orderBy("week_start")
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))

    def upto(c, start):
        return F.coalesce(F.sum(c).over(along), F.lit(start))
    out = line.select(*keys, *carry, "_cell", upto("_events", 0).cast("bigint").alias("events_active"),
                      upto("_price", 0.0).alias("_price"), upto("_volume", 0.0).alias("_volume"),
                      upto("_unknown", 0).alias("_unknown")).filter("_cell")
    return out.select(*keys, *carry, "events_active", F.exp("_price").alias("price_mult"),
                      F.when(F.col("_unknown") == 0, F.exp("_volume")).alias("volume_mult"))


def elastic_projection(settled: DataFrame, events_m: DataFrame, promos: DataFrame,
                       weeks: int = P.DID_WINDOW_WEEKS, z: float = P.Z90, panel: DataFrame | None = None) -> DataFrame:
    """P17 on measured data: every complete-week (week, market, sku) cell of the panel with
    the price multiplier of the executed events active in it and the volume multiplier that
    the DiD elasticity measured for each of those events implies.

    The panel is one aggregate of the fact; the running products take one shuffle of it by
    market and sku. Pass a cached ``panel`` so the DiD and the projection share one scan of
    the fact."""
    panel = weekly_panel(settled) if panel is None else panel
    did = did_from_panel(panel, events_m, promos, weeks, z).select("event_id", "market", "elasticity")
    ev = events_m.join(did, ["event_id", "market"], "left")
    m = elastic_multiplier(panel, ev, "elasticity", carry=("bookings",))
    return m.select("week_start", "market", "sku", "bookings", "events_active",
                    _round6(F.col("price_mult")).alias("price_mult"), _round6(F.col("volume_mult")).alias("volume_mult"))