"""Oracle SQL for the coupon-policy keys."""

from __future__ import annotations

from .. import params as P
from .bookings_sql import rules_cte, values_cte
from .rollups_sql import BUCKETED, TOPS
from .sql_common import CNT, PCT, S, sql

FAMILY = values_cte("family", ["coupon_code", "cap_pct"], P.FAMILY_RULES, {"cap_pct": "INTEGER"})
TIERS = values_cte("tiers", ["tier_order", "depth_tier"], list(enumerate(P.DEPTH_TIERS)), {"tier_order": "INTEGER"})

CAMPAIGN = f"""
campaign AS (
  SELECT coupon_code, COUNT(*) AS bookings, {S('net_c')} AS revenue, {S('gm_c')} AS gm,
         AVG(total_disc_pct) AS avg_total_disc_pct, AVG(coupon_pct) AS avg_coupon_disc_pct,
         AVG(total_member) AS avg_members,
         AVG(CAST(COALESCE(booking_flag = 'Fresh', FALSE) AS INTEGER)) AS fresh_pct,
         AVG(CAST(COALESCE(booked_by = 'Self', FALSE) AS INTEGER)) AS self_pct,
         AVG(CAST(COALESCE(vip_c > 0, FALSE) AS INTEGER)) AS vip_stack_pct,
         {PCT(S('gm_c'), S('net_c'))} AS gm_pct
  FROM clean WHERE coupon_code IS NOT NULL GROUP BY coupon_code
)"""

RULE_ROWS = """
rule_rows AS (
  SELECT c.coupon_code, r.mov_c, r.upper_limit, COUNT(*) AS bookings,
         CAST(SUM(CASE WHEN c.offer_c < r.mov_c THEN 1 ELSE 0 END) AS BIGINT) AS below_mov,
         CAST(SUM(CASE WHEN c.coupon_pct > r.upper_limit + 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS over_upper_limit
  FROM clean c JOIN rules r ON r.coupon_code = c.coupon_code
  GROUP BY c.coupon_code, r.mov_c, r.upper_limit
)"""

DEPTH = """CASE WHEN n_disc = 0 THEN '0% - no discount'
     WHEN n_disc = 1 AND coupon_c > 0 AND offer_c <= 0 THEN 'unknown'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.1 THEN '1-10%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.2 THEN '10-20%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.3 THEN '20-30%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.4 THEN '30-40%'
     WHEN n_disc = 1 AND coupon_c > 0 THEN '40%+' END"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["campaign_rules"] = sql("""
SELECT c.*, r.mov_c, r.discount, r.upper_limit, r.rule_type, r.coupon_code IS NOT NULL AS known_in_crm
FROM campaign c LEFT JOIN rules r ON r.coupon_code = c.coupon_code""", CAMPAIGN, rules_cte())
    q["campaign_scorecard"] = q["campaign_rules"]
    q["top_campaigns"] = sql("""
SELECT c.*, r.mov_c, r.discount, r.upper_limit, r.rule_type, r.coupon_code IS NOT NULL AS known_in_crm
FROM campaign c LEFT JOIN rules r ON r.coupon_code = c.coupon_code
ORDER BY c.bookings DESC, c.coupon_code ASC LIMIT 30""", CAMPAIGN, rules_cte())
    q["addfamily_check"] = sql(f"""
SELECT c.coupon_code, f.cap_pct, COUNT(*) AS n, AVG(total_disc_pct) AS avg_total_disc_pct,
       MAX(total_disc_pct) AS max_total_disc_pct,
       AVG(CAST(COALESCE(vip_c > 0, FALSE) AS INTEGER)) AS vip_stack_share,
       AVG(total_member) AS avg_members,
       AVG(CAST(COALESCE(booking_flag = 'Fresh', FALSE) AS INTEGER)) AS fresh_share,
       AVG(CAST(COALESCE(booked_by = 'Self', FALSE) AS INTEGER)) AS self_share,
       AVG(CAST(COALESCE(total_disc_pct > f.cap_pct, FALSE) AS INTEGER)) AS over_cap_share
FROM clean c JOIN family f ON f.coupon_code = c.coupon_code GROUP BY c.coupon_code, f.cap_pct""", FAMILY)
    q["stacking_curve"] = sql(f"""
SELECT n_disc AS n_disc_types, COUNT(*) AS n, {S('net_c')} AS revenue, {S('gm_c')} AS gm,
       {PCT(S('gm_c'), S('net_c'))} AS gm_pct FROM clean GROUP BY n_disc""")
    q["depth_curve"] = sql(f"""
SELECT t.tier_order, t.depth_tier, CAST(COALESCE(a.n, 0) AS BIGINT) AS n,
       CAST(COALESCE(a.revenue, 0) AS BIGINT) AS revenue, CAST(COALESCE(a.gm, 0) AS BIGINT) AS gm,
       {PCT("a.gm", "a.revenue")} AS gm_pct
FROM tiers t LEFT JOIN (
  SELECT depth_tier, COUNT(*) AS n, {S('net_c')} AS revenue, {S('gm_c')} AS gm
  FROM (SELECT *, {DEPTH} AS depth_tier FROM clean) WHERE depth_tier IS NOT NULL GROUP BY depth_tier) a
ON a.depth_tier = t.depth_tier""", TIERS)
    q["rule_rows"] = sql("SELECT * FROM rule_rows", rules_cte(), RULE_ROWS)
    q["mov_compliance"] = sql("""
SELECT coupon_code, mov_c, bookings, CAST(below_mov AS DOUBLE) / bookings AS pct_bookings_below_stated_mov
FROM rule_rows WHERE mov_c > 0 AND bookings >= 10""", rules_cte(), RULE_ROWS)
    q["upper_limit_breach"] = sql("""
SELECT * FROM (
  SELECT coupon_code, upper_limit, bookings, CAST(over_upper_limit AS DOUBLE) / bookings AS pct_bookings_over_upper_limit
  FROM rule_rows WHERE upper_limit > 0 AND bookings >= 10) WHERE pct_bookings_over_upper_limit > 0.05""",
                                  rules_cte(), RULE_ROWS)
    q["mov_weekly"] = sql(f"""
SELECT week_start, coupon_bucket, COUNT(*) AS bookings, {CNT('b.offer_c < r.mov_c')} AS bookings_below_mov,
       {PCT(CNT('b.offer_c < r.mov_c'), 'COUNT(*)')} AS pct_below_mov
FROM bucketed b LEFT JOIN rules r ON r.coupon_code = b.coupon_code GROUP BY week_start, coupon_bucket""",
                          *TOPS, BUCKETED, rules_cte())
    fam = ", ".join(f"'{c}'" for c in P.FAMILY_CODES)
    q["addfamily_weekly"] = sql(f"""
SELECT week_start, coupon_code AS coupon_bucket, COUNT(*) AS bookings, AVG(total_member) AS avg_total_member,
       AVG(total_disc_pct) AS avg_discount_pct, AVG(CAST(COALESCE(vip_c > 0, FALSE) AS INTEGER)) AS pct_vip_stacked,
       AVG(CAST(COALESCE(booked_by = 'Self', FALSE) AS INTEGER)) AS pct_self_channel
FROM clean WHERE coupon_code IN ({fam}) GROUP BY week_start, coupon_code""")
    q["unknown_codes"] = sql("""
SELECT coupon_code, COUNT(*) AS bookings FROM clean
WHERE coupon_code IS NOT NULL AND coupon_code NOT IN (SELECT coupon_code FROM rules) GROUP BY coupon_code""",
                             rules_cte())
    q["coupon_age"] = sql(f"""
SELECT w.*, r.create_date, CAST(FLOOR(date_diff('day', r.create_date, w.week_start) / 7e0) AS INTEGER)
         AS weeks_since_create
FROM (SELECT week_start, coupon_code, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum
      FROM clean WHERE coupon_code IS NOT NULL GROUP BY week_start, coupon_code) w
LEFT JOIN rules r ON r.coupon_code = w.coupon_code""", rules_cte())
    q["over_limit_offers"] = sql(f"""
SELECT coupon_code, COUNT(*) AS bookings, MAX(coupon_pct) AS depth_pct, {S('gm_c')} AS gm_sum,
       {S('net_c')} AS revenue_sum, {S('coupon_c')} AS coupon_sum, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
FROM clean WHERE coupon_pct > {P.OVER_LIMIT_CEILING} GROUP BY coupon_code""")
    q["attention_flags"] = sql(f"""
SELECT c.coupon_code, c.bookings, c.gm_pct, m.pct_bookings_below_stated_mov,
       COALESCE(m.pct_bookings_below_stated_mov > {P.MOV_ATTENTION_SHARE}, FALSE) AS mov_attention,
       COALESCE(c.gm_pct < {P.CAMPAIGN_GM_ATTENTION}, FALSE) AS gm_attention
FROM campaign c LEFT JOIN (
  SELECT coupon_code, CAST(below_mov AS DOUBLE) / bookings AS pct_bookings_below_stated_mov
  FROM rule_rows WHERE mov_c > 0 AND bookings >= 10) m ON m.coupon_code = c.coupon_code""",
                               CAMPAIGN, rules_cte(), RULE_ROWS)
    return q
