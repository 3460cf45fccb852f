"""Oracle SQL for pricing and policy keys."""

from __future__ import annotations

from .. import params as P
from .bookings_sql import competitor_cte, price_actions_cte, price_events_cte, promo_events_cte, rules_cte, values_cte
from .sql_common import PCT, S, sql

W = 28
K = P.DID_WINDOW_WEEKS
R6 = "FLOOR(({x}) * 1e6 + 0.5) / 1e6"


def r6(x: str) -> str:
    return R6.format(x=x)


EV = price_events_cte()
EXEC = "ev_x AS (SELECT * FROM price_events WHERE change_week IS NOT NULL)"
CELLS = f"""cells AS (SELECT booking_date, sku, market, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum,
  {S('net_c')} AS revenue_sum, {S('offer_c')} AS offer_sum FROM clean GROUP BY booking_date, sku, market)"""
RANGE = f"""rng AS (
  SELECT e.event_id, e.market, c.booking_date, CASE WHEN c.booking_date < e.change_week THEN 'pre' ELSE 'post' END
         AS side, c.bookings, c.gm_sum, c.revenue_sum, c.offer_sum
  FROM cells c JOIN ev_x e ON c.sku = e.sku AND c.market = e.market
   AND c.booking_date BETWEEN e.change_week - INTERVAL {W} DAY AND e.change_week + INTERVAL {W - 1} DAY)"""
PANEL = """panel AS (SELECT week_start, market, sku, COUNT(*) AS bookings FROM settled WHERE NOT is_partial
  GROUP BY week_start, market, sku)"""
ARMS = f"""arms AS (
  SELECT event_id, sku, market, change_week, 'T' AS arm, market AS arm_market FROM ev_x
  UNION ALL SELECT event_id, sku, market, change_week, 'C', control_market FROM ev_x),
tot AS (
  SELECT a.event_id, a.market,
    {S("CASE WHEN a.arm = 'T' AND p.week_start < a.change_week THEN p.bookings END")} AS t_pre,
    {S("CASE WHEN a.arm = 'T' AND p.week_start >= a.change_week THEN p.bookings END")} AS t_post,
    {S("CASE WHEN a.arm = 'C' AND p.week_start < a.change_week THEN p.bookings END")} AS c_pre,
    {S("CASE WHEN a.arm = 'C' AND p.week_start >= a.change_week THEN p.bookings END")} AS c_post
  FROM panel p JOIN arms a ON p.sku = a.sku AND p.market = a.arm_market
   AND p.week_start BETWEEN a.change_week - INTERVAL {7 * K} DAY AND a.change_week + INTERVAL {7 * K - 7} DAY
  GROUP BY a.event_id, a.market)"""
CONF = f"""conf AS (
  SELECT e.event_id, e.market, COUNT(p.week_start) AS promos_in_post, COUNT(p.week_start) > 0 AS confounded
  FROM ev_x e LEFT JOIN (SELECT * FROM promo_events WHERE scope = 'market') p
    ON p.market = e.market AND p.week_start BETWEEN e.change_week AND e.change_week + INTERVAL {7 * K - 7} DAY
  GROUP BY e.event_id, e.market)"""
CONTAM = f"""contam AS (
SELECT a.event_id, a.market, a.control_events, b.control_promos, a.control_events > 0 OR b.control_promos > 0
         AS contaminated
FROM (SELECT e.event_id, e.market, COUNT(o.event_id) AS control_events FROM ev_x e LEFT JOIN ev_x o
        ON o.sku = e.sku AND o.market = e.control_market
       AND o.change_week BETWEEN e.change_week - INTERVAL {7 * K} DAY AND e.change_week + INTERVAL {7 * K - 7} DAY
      GROUP BY e.event_id, e.market) a
JOIN (SELECT e.event_id, e.market, COUNT(p.week_start) AS control_promos FROM ev_x e
        LEFT JOIN (SELECT * FROM promo_events WHERE scope = 'market') p ON p.market = e.control_market
       AND p.week_start BETWEEN e.change_week - INTERVAL {7 * K} DAY AND e.change_week + INTERVAL {7 * K - 7} DAY
      GROUP BY e.event_id, e.market) b ON a.event_id = b.event_id AND a.market = b.market)"""
CCC = f"""ccc AS (
SELECT e.event_id, e.market, COUNT(r.coupon_code) AS coupons_created,
       COALESCE(string_agg(DISTINCT r.coupon_code, ',' ORDER BY r.coupon_code), '') AS coupon_codes
FROM ev_x e LEFT JOIN (SELECT * FROM rules WHERE create_date IS NOT NULL) r
  ON r.create_date BETWEEN e.change_week - INTERVAL {W} DAY AND e.change_week + INTERVAL {W - 1} DAY
GROUP BY e.event_id, e.market)"""
LIST = """lp AS (SELECT p_type AS sku, CAST(FLOOR(MAX(p_retailprice) * 100 + 0.5) AS BIGINT) AS list_c
  FROM part GROUP BY p_type)"""
MM = values_cte("mm", ["market", "market_mult"], sorted(P.MARKET_PRICE_MULT.items()), {"market_mult": "DOUBLE"})
PER = """per AS (
  SELECT e.event_id, e.sku, e.market, o.old_price_c,
         CAST(FLOOR(o.old_price_c * (100 + e.pct_change) / 100e0 + 0.5) AS BIGINT) AS new_price_c,
         e.pct_change, e.status, e.change_week AS change_date, e.control_market
  FROM price_events e JOIN (
    SELECT e2.event_id, e2.market, CAST(FLOOR(lp.list_c * mm.market_mult + 0.5) AS BIGINT) AS old_price_c
    FROM price_events e2 JOIN lp ON lp.sku = e2.sku JOIN mm ON mm.market = e2.market) o
  ON o.event_id = e.event_id AND o.market = e.market)"""
EXPO = f"""tcp AS (
  SELECT package_code, coupon_code AS top_coupon, n AS top_coupon_n FROM (
    SELECT package_code, coupon_code, n,
           ROW_NUMBER() OVER (PARTITION BY package_code ORDER BY n DESC, coupon_code ASC) AS rn
    FROM (SELECT package_code, coupon_code, COUNT(*) AS n FROM clean WHERE coupon_c > 0
          GROUP BY package_code, coupon_code)) WHERE rn = 1),
expo AS (
  SELECT e.*, t.top_coupon, t.top_coupon_n FROM (
    SELECT trim(CAST(package_code AS VARCHAR)) AS package_code, COUNT(*) AS n_bookings,
           AVG(CAST(COALESCE(coupon_c > 0, FALSE) AS INTEGER)) AS coupon_penetration,
           AVG(total_disc_pct) AS avg_total_disc_pct, {PCT("SUM(gm_c)", "SUM(net_c)")} AS gm_pct
    FROM clean GROUP BY 1) e LEFT JOIN tcp t ON t.package_code = e.package_code),
pae AS (
  SELECT a.*, x.n_bookings, x.coupon_penetration, x.avg_total_disc_pct, x.gm_pct, x.top_coupon, x.top_coupon_n,
         x.package_code IS NOT NULL AS has_exposure
  FROM price_actions a LEFT JOIN expo x ON x.package_code = a.package_code),
risk AS (
  SELECT *, CASE WHEN coupon_penetration IS NULL THEN '{P.RISK_NO_DATA}'
    WHEN COALESCE(actual_price_pct_change < 0 AND coupon_penetration > 0.5 AND avg_total_disc_pct > 15, FALSE)
      THEN '{P.RISK_HIGH}'
    WHEN COALESCE(actual_price_pct_change > 0 AND coupon_penetration < 0.15, FALSE) THEN '{P.RISK_LOW_CLEAN}'
    WHEN coupon_penetration > 0.5 THEN '{P.RISK_MEDIUM}' ELSE '{P.RISK_LOW}' END AS stacking_risk FROM pae)"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["event_window_range"] = sql("SELECT * FROM rng", EV, EXEC, CELLS, RANGE)
    q["price_event_daily"] = sql(f"""
SELECT e.event_id, e.market, e.status, COUNT(c.booking_date) AS matched_days, MIN(c.booking_date) AS first_day,
       MAX(c.booking_date) AS last_day, COUNT(c.booking_date) > 0 AS matched
FROM price_events e LEFT JOIN cells c ON e.sku = c.sku AND e.market = c.market
 AND c.booking_date BETWEEN e.change_week - INTERVAL {W} DAY AND e.change_week + INTERVAL {W - 1} DAY
GROUP BY e.event_id, e.market, e.status""", EV, CELLS)
    imp = f"""imp AS (
  SELECT *, post_gm_pct - pre_gm_pct AS gm_pct_delta, post_asp - pre_asp AS asp_delta FROM (
    SELECT *, {PCT("pre_gm", "pre_revenue")} AS pre_gm_pct, {PCT("post_gm", "post_revenue")} AS post_gm_pct,
           CAST(pre_offer AS DOUBLE) / NULLIF(pre_bookings, 0) AS pre_asp,
           CAST(post_offer AS DOUBLE) / NULLIF(post_bookings, 0) AS post_asp FROM (
      SELECT event_id, market,
        {S("CASE WHEN side = 'pre' THEN bookings END")} AS pre_bookings,
        {S("CASE WHEN side = 'post' THEN bookings END")} AS post_bookings,
        {S("CASE WHEN side = 'pre' THEN gm_sum END")} AS pre_gm,
        {S("CASE WHEN side = 'post' THEN gm_sum END")} AS post_gm,
        {S("CASE WHEN side = 'pre' THEN revenue_sum END")} AS pre_revenue,
        {S("CASE WHEN side = 'post' THEN revenue_sum END")} AS post_revenue,
        {S("CASE WHEN side = 'pre' THEN offer_sum END")} AS pre_offer,
        {S("CASE WHEN side = 'post' THEN offer_sum END")} AS post_offer
      FROM rng GROUP BY event_id, market)))"""
    q["price_event_impact"] = sql("""
SELECT i.*, c.coupons_created, c.coupon_codes FROM imp i
LEFT JOIN ccc c ON c.event_id = i.event_id AND c.market = i.market""", EV, EXEC, CELLS, RANGE, imp, rules_cte(), CCC)
    vol = PCT("i.post_bookings - i.pre_bookings", "i.pre_bookings")
    q["arc_elasticity"] = sql(f"""
SELECT i.event_id, i.market, e.pct_change, i.pre_bookings, i.post_bookings, {vol} AS volume_pct,
       ({vol}) / NULLIF(e.pct_change, 0) AS arc_elasticity
FROM imp i JOIN ev_x e ON e.event_id = i.event_id AND e.market = i.market""", EV, EXEC, CELLS, RANGE, imp)
    ok = "t.t_pre > 0 AND t.t_post > 0 AND t.c_pre > 0 AND t.c_post > 0"
    lnp = "ln(1 + e.pct_change / 100e0)"
    est = (f"(ln(CAST(t.t_post AS DOUBLE) / t.t_pre) - ln(CAST(t.c_post AS DOUBLE) / t.c_pre)) / {lnp}")
    se = (f"sqrt(1e0 / t.t_pre + 1e0 / t.t_post + 1e0 / t.c_pre + 1e0 / t.c_post) / abs({lnp})")
    q["did_elasticity"] = sql(f"""
SELECT t.event_id, t.market, e.control_market, e.pct_change, t.t_pre, t.t_post, t.c_pre, t.c_post,
       CASE WHEN {ok} THEN {r6(est)} END AS elasticity, CASE WHEN {ok} THEN {r6(se)} END AS se,
       CASE WHEN {ok} THEN {r6(f"{est} - {P.Z90} * {se}")} END AS ci_lo,
       CASE WHEN {ok} THEN {r6(f"{est} + {P.Z90} * {se}")} END AS ci_hi,
       c.confounded, k.contaminated
FROM tot t JOIN ev_x e ON e.event_id = t.event_id AND e.market = t.market
JOIN conf c ON c.event_id = t.event_id AND c.market = t.market
JOIN contam k ON k.event_id = t.event_id AND k.market = t.market""", EV, EXEC, promo_events_cte(), PANEL, ARMS, CONF,
                              CONTAM)
    did = f"""did AS (SELECT t.event_id, t.market, CASE WHEN {ok} THEN {r6(est)} END AS elasticity
FROM tot t JOIN ev_x e ON e.event_id = t.event_id AND e.market = t.market)"""
    g = "ln(1 + e.pct_change / 100e0)"
    q["elastic_projection"] = sql(f"""
SELECT p.week_start, p.market, p.sku, p.bookings, COUNT(e.event_id) AS events_active,
       {r6(f"COALESCE(exp(SUM({g})), 1e0)")} AS price_mult,
       CASE WHEN COUNT(e.event_id) = COUNT(d.elasticity)
            THEN {r6(f"COALESCE(exp(SUM(d.elasticity * {g})), 1e0)")} END AS volume_mult
FROM panel p LEFT JOIN ev_x e ON e.sku = p.sku AND e.market = p.market AND e.change_week <= p.week_start
LEFT JOIN did d ON d.event_id = e.event_id AND d.market = e.market
GROUP BY p.week_start, p.market, p.sku, p.bookings""", EV, EXEC, PANEL, ARMS, did)
    q["did_pairing"] = sql(f"""
SELECT e.event_id, e.market, p.week_start, CAST(date_diff('day', e.change_week, p.week_start) / 7 AS INTEGER)
         AS rel_week, p.bookings AS treated_bookings, c.bookings AS control_bookings
FROM panel p JOIN ev_x e ON p.sku = e.sku AND p.market = e.market
 AND p.week_start BETWEEN e.change_week - INTERVAL {7 * K} DAY AND e.change_week + INTERVAL {7 * K - 7} DAY
LEFT JOIN panel c ON c.sku = e.sku AND c.market = e.control_market AND c.week_start = p.week_start""",
                           EV, EXEC, PANEL)
    q["price_event_rows"] = sql("""
SELECT event_id, sku, market, old_price_c, new_price_c, new_price_c - old_price_c AS price_change_c, pct_change,
       status, change_date, control_market FROM per""", EV, LIST, MM, PER)
    q["flat_volume_impact"] = sql(f"""
SELECT p.event_id, p.market, p.old_price_c, p.new_price_c, p.new_price_c - p.old_price_c AS price_change_c,
       p.pct_change, COALESCE(t.t_pre, 0) / {float(K)} AS weekly_bookings,
       (p.new_price_c - p.old_price_c) * (COALESCE(t.t_pre, 0) / {float(K)}) AS weekly_revenue_impact_c,
       CAST(SUM((p.new_price_c - p.old_price_c) * COALESCE(t.t_pre, 0)) OVER () AS BIGINT) / {float(K)}
         AS total_weekly_revenue_impact_c
FROM per p LEFT JOIN tot t ON t.event_id = p.event_id AND t.market = p.market
WHERE p.change_date IS NOT NULL""", EV, EXEC, LIST, MM, PER, PANEL, ARMS)
    q["competitor_gap"] = sql("""
SELECT lp.sku, c.competitor, lp.list_c, CAST(FLOOR(lp.list_c * c.mult + 0.5) AS BIGINT) AS competitor_price_c,
       100e0 * (CAST(FLOOR(lp.list_c * c.mult + 0.5) AS BIGINT) - lp.list_c) / NULLIF(lp.list_c, 0) AS gap_pct,
       COALESCE(rp.raise_planned, FALSE) AS raise_planned,
       COALESCE(rp.raise_planned, FALSE) AND CAST(FLOOR(lp.list_c * c.mult + 0.5) AS BIGINT) < lp.list_c AS warn
FROM lp JOIN competitor_mult c ON c.sku = lp.sku
LEFT JOIN (SELECT sku, MAX(CAST(pct_change > 0 AS INTEGER)) > 0 AS raise_planned FROM price_events GROUP BY sku) rp
  ON rp.sku = lp.sku""", EV, LIST, competitor_cte())
    q["competitor_gap_by_city"] = sql("""
SELECT o.sku, o.city, o.market, c.competitor, o.bookings, o.price_c, t.competitor_price_c,
       100e0 * (t.competitor_price_c - o.price_c) / NULLIF(o.price_c, 0) AS gap_pct,
       COALESCE(rp.raise_planned, FALSE) AS raise_planned,
       COALESCE(rp.raise_planned, FALSE) AND t.competitor_price_c < o.price_c AS warn
FROM (SELECT sku, city, market, COUNT(*) AS bookings, CAST(SUM(offer_c) AS DOUBLE) / COUNT(*) AS price_c
      FROM clean GROUP BY sku, city, market) o
JOIN competitor_mult c ON c.sku = o.sku
JOIN (SELECT lp.sku, m.competitor, CAST(FLOOR(lp.list_c * m.mult + 0.5) AS BIGINT) AS competitor_price_c
      FROM lp JOIN competitor_mult m ON m.sku = lp.sku) t ON t.sku = o.sku AND t.competitor = c.competitor
LEFT JOIN (SELECT sku, market, MAX(pct_change) > 0 AS raise_planned FROM price_events GROUP BY sku, market) rp
  ON rp.sku = o.sku AND rp.market = o.market""", EV, LIST, competitor_cte())
    q["price_action_exposure"] = sql("SELECT * FROM pae", price_actions_cte(), EXPO)
    q["stacking_risk"] = sql("""
SELECT *, starts_with(stacking_risk, 'HIGH') OR starts_with(stacking_risk, 'MEDIUM') AS risk_attention FROM risk""",
                             price_actions_cte(), EXPO)
    q["risk_driver"] = sql(f"""
SELECT top_coupon, COUNT(*) AS high_risk_packages, {S('weekly_gm_delta_c')} AS weekly_gm_delta_c
FROM risk WHERE starts_with(stacking_risk, 'HIGH') GROUP BY top_coupon""", price_actions_cte(), EXPO)
    q["breakeven_elasticity"] = sql(f"""
SELECT package_code, COUNT(*) AS bookings, {S('offer_c')} AS offer_sum, {S('cpt_c')} AS cost_sum,
       CASE WHEN {S('offer_c')} - {S('cpt_c')} > 0 THEN -{S('offer_c')} / ({S('offer_c')} - {S('cpt_c')}) END
         AS breakeven_elasticity
FROM clean GROUP BY package_code""")
    disc = "special_c + vip_c + coupon_c + redcash_c + giftcard_c"
    q["cap_scenarios"] = sql(f"""
SELECT a.cap, r.loss_rate, a.affected_bookings,
       a.disc_aff - (CAST(l.disc AS DOUBLE) / l.offer) * a.offer_aff AS gross_recovered, a.gm_aff AS at_risk_gm,
       (a.disc_aff - (CAST(l.disc AS DOUBLE) / l.offer) * a.offer_aff)
         - r.loss_rate * (a.gm_aff + (a.disc_aff - (CAST(l.disc AS DOUBLE) / l.offer) * a.offer_aff)) AS net_change,
       (a.disc_aff - (CAST(l.disc AS DOUBLE) / l.offer) * a.offer_aff)
         / NULLIF(a.gm_aff + (a.disc_aff - (CAST(l.disc AS DOUBLE) / l.offer) * a.offer_aff), 0)
         AS break_even_loss_rate
FROM (SELECT c.cap, CAST(SUM(lv.bookings) AS BIGINT) AS affected_bookings, CAST(SUM(lv.offer) AS BIGINT) AS offer_aff,
             CAST(SUM(lv.disc) AS BIGINT) AS disc_aff, CAST(SUM(lv.gm) AS BIGINT) AS gm_aff
      FROM lv JOIN (VALUES (1), (2), (3)) AS c(cap) ON lv.level > c.cap GROUP BY c.cap) a
LEFT JOIN lv l ON l.level = a.cap
CROSS JOIN (VALUES (0.0e0), (0.05e0), (0.1e0), (0.2e0)) AS r(loss_rate)""",
                             f"""lv AS (SELECT n_disc AS level, COUNT(*) AS bookings, {S('offer_c')} AS offer,
  {S(disc)} AS disc, {S('gm_c')} AS gm FROM settled WHERE NOT is_partial GROUP BY n_disc)""")
    ranks = " + ".join([f"percent_rank() OVER (ORDER BY {k} ASC)" for k in
                        ("revenue", "bookings", "aov", "repeat_share", "discount_efficiency")]
                       + ["percent_rank() OVER (ORDER BY concentration DESC)"])
    q["coupon_health"] = sql(f"""
SELECT *, CASE WHEN health_score >= 0.66 THEN 'healthy' WHEN health_score >= 0.33 THEN 'watch' ELSE 'at risk' END
         AS health FROM (
  SELECT *, {r6(f"({ranks}) / 6e0")} AS health_score FROM (
    SELECT p.coupon_code, p.bookings, p.revenue, CAST(p.offer AS DOUBLE) / p.bookings AS aov,
           CAST(p.repeat_n AS DOUBLE) / NULLIF(p.bookings, 0) AS repeat_share,
           CAST(t.top_package_n AS DOUBLE) / NULLIF(p.bookings, 0) AS concentration,
           CAST(p.gm AS DOUBLE) / NULLIF(p.coupon_sum, 0) AS discount_efficiency
    FROM (SELECT coupon_code, COUNT(*) AS bookings, {S('net_c')} AS revenue, {S('gm_c')} AS gm,
                 {S('offer_c')} AS offer, {S('coupon_c')} AS coupon_sum,
                 CAST(SUM(CASE WHEN booking_flag = 'Repeat' THEN 1 ELSE 0 END) AS BIGINT) AS repeat_n
          FROM clean WHERE coupon_code IS NOT NULL GROUP BY coupon_code) p
    JOIN (SELECT coupon_code, MAX(n) AS top_package_n FROM (
            SELECT coupon_code, package_code, COUNT(*) AS n FROM clean WHERE coupon_code IS NOT NULL
            GROUP BY coupon_code, package_code) GROUP BY coupon_code) t ON t.coupon_code = p.coupon_code))""")
    return q
