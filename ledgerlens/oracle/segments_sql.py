"""Oracle SQL for segment, channel, geography and operations keys."""

from __future__ import annotations

from .. import params as P
from .sql_common import CNT, PCT, S, bucket, sql, summary_cols, top_cte

SHARE = "AVG(CAST(COALESCE({p}, FALSE) AS INTEGER))"
HAS_COUPON = "COALESCE(coupon_c > 0, FALSE)"


def share(p: str) -> str:
    return SHARE.format(p=p)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["segment_mix"] = sql(f"""
SELECT *, {PCT("gm", "revenue")} AS gm_pct, {PCT("revenue", "(SELECT SUM(revenue) FROM g)")} AS rev_share FROM g""",
                           f"""g AS (SELECT booking_flag, customer_category, COUNT(*) AS bookings, {S('net_c')} AS revenue,
  {S('gm_c')} AS gm, {share(HAS_COUPON)} AS coupon_pen, AVG(total_disc_pct) AS avg_disc,
  AVG(total_member) AS avg_members FROM clean GROUP BY booking_flag, customer_category)""")
    q["segment_channel"] = sql(f"""
SELECT booking_flag, customer_category, booked_by, COUNT(*) AS bookings, {S('net_c')} AS revenue, {S('gm_c')} AS gm,
       {share(HAS_COUPON)} AS coupon_pen, AVG(total_disc_pct) AS avg_disc, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
FROM clean GROUP BY booking_flag, customer_category, booked_by""")
    top_pair = """tcp AS (
  SELECT package_code, coupon_code AS top_coupon, n AS top_coupon_n FROM (
    SELECT package_code, coupon_code, n,
           ROW_NUMBER() OVER (PARTITION BY package_code ORDER BY n DESC, coupon_code ASC) AS rn
    FROM (SELECT package_code, coupon_code, COUNT(*) AS n FROM clean WHERE coupon_c > 0
          GROUP BY package_code, coupon_code)) WHERE rn = 1)"""
    q["top_coupon_per_package"] = sql("SELECT * FROM tcp", top_pair)
    q["package_exposure"] = sql(f"""
SELECT e.*, t.top_coupon, t.top_coupon_n FROM (
  SELECT trim(CAST(package_code AS VARCHAR)) AS package_code, COUNT(*) AS n_bookings,
         {share(HAS_COUPON)} AS coupon_penetration, AVG(total_disc_pct) AS avg_total_disc_pct,
         {PCT("SUM(gm_c)", "SUM(net_c)")} AS gm_pct
  FROM clean GROUP BY 1) e LEFT JOIN tcp t ON t.package_code = e.package_code""", top_pair)
    q["daily_scorecard"] = sql(f"""
SELECT booking_date, COUNT(*) AS bookings, {S('net_c')} AS revenue, {S('gm_c')} AS gm,
       {share(HAS_COUPON)} AS coupon_pen, AVG(total_disc_pct) AS avg_disc,
       {CNT("booking_flag = 'Fresh'")} AS fresh_bookings, {CNT("booking_flag = 'Repeat'")} AS repeat_bookings,
       {CNT("customer_category = 'vip gold'")} AS vip_gold_bookings, {CNT("booked_by = 'Self'")} AS self_bookings,
       {CNT("booked_by = 'Sales'")} AS sales_bookings, {CNT("booked_by = 'Phlebo'")} AS phlebo_bookings,
       {PCT(S('gm_c'), S('net_c'))} AS gm_pct, CAST({CNT("booking_flag = 'Fresh'")} AS DOUBLE) / COUNT(*) AS fresh_pct
FROM clean GROUP BY booking_date""")
    q["agent_weekly"] = sql(f"""
SELECT week_start, agent_id, {summary_cols()} FROM (
  SELECT week_start, gm_c, net_c, {bucket("agent_id", "top_agent")} AS agent_id FROM sales)
GROUP BY week_start, agent_id""", "sales AS (SELECT * FROM clean WHERE booked_by = 'Sales')",
                            top_cte("top_agent", "sales", "agent_id", P.TOP_N["agent20"]))
    q["agent_leaderboard"] = sql(f"""
SELECT * FROM (SELECT agent_id, {summary_cols(True)} FROM clean
               WHERE booked_by = 'Sales' AND agent_id IS NOT NULL GROUP BY agent_id)
WHERE bookings >= {P.AGENT_FLOOR}""")
    q["slot_status"] = """
SELECT CAST(hour(ts) AS INTEGER) AS collection_slot, event_type AS pickup_status, COUNT(*) AS bookings
FROM events GROUP BY 1, 2"""
    q["premium_split"] = sql(f"""
SELECT is_premium, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum,
       {S('offer_c')} AS offer_sum, {PCT(S('gm_c'), S('net_c'))} AS gm_pct, {S('offer_c')} / COUNT(*) AS aov
FROM clean GROUP BY is_premium""")
    q["combo_vs_single"] = sql(f"""
SELECT COALESCE(contains(package_code, ','), FALSE) AS is_combo, {summary_cols(True)} FROM clean GROUP BY 1""")
    segs = [(f.lower() + "_" + c.replace(" ", "_"), f, c) for f in (P.FRESH, P.REPEAT) for c in P.CATEGORIES]
    piv = ", ".join(
        f"{PCT(f'SUM(CASE WHEN booking_flag = {chr(39)}{f}{chr(39)} AND customer_category = {chr(39)}{c}{chr(39)} THEN gm_c END)', f'SUM(CASE WHEN booking_flag = {chr(39)}{f}{chr(39)} AND customer_category = {chr(39)}{c}{chr(39)} THEN net_c END)')} AS {name}"
        for name, f, c in segs)
    piv += ", " + ", ".join(
        f"SUM(CASE WHEN booking_flag = '{f}' AND customer_category = '{c}' THEN offer_c END) / "
        f"CAST(NULLIF(COUNT(CASE WHEN booking_flag = '{f}' AND customer_category = '{c}' THEN offer_c END), 0) AS DOUBLE) "
        f"AS {name}_aov" for name, f, c in segs)
    q["city_segment_matrix"] = sql(f"SELECT city, {piv} FROM clean GROUP BY city")
    kinds = [("k0", "n_disc = 0"), ("k1", "n_disc = 1"), ("k2", "n_disc = 2"), ("k3plus", "n_disc >= 3")]
    piv2 = ", ".join(f"{PCT(f'SUM(CASE WHEN {c} THEN gm_c END)', f'SUM(CASE WHEN {c} THEN net_c END)')} AS {n}"
                     for n, c in kinds)
    q["stacking_heatmap"] = sql(f"SELECT week_start, {piv2} FROM clean GROUP BY week_start")
    q["channel_split"] = sql(f"""
SELECT week_start, booked_by, bookings, gm_sum, revenue_sum, avg_discount_pct,
       {PCT("bookings", "SUM(bookings) OVER (PARTITION BY week_start)")} AS volume_share,
       {PCT("SUM(gm_sum) OVER (PARTITION BY week_start)", "SUM(revenue_sum) OVER (PARTITION BY week_start)")}
         AS blended_gm_pct,
       {PCT("gm_sum", "revenue_sum")} AS gm_pct, offer_sum / bookings AS aov
FROM (SELECT week_start, booked_by, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum,
             {S('offer_c')} AS offer_sum, AVG(total_disc_pct) AS avg_discount_pct
      FROM clean GROUP BY week_start, booked_by)""")
    q["attach_rates"] = sql(f"""
SELECT customer_category, booked_by, COUNT(*) AS bookings, {share("express_fee_c > 0")} AS express_attach,
       {share("hardcopy_fee_c > 0")} AS hardcopy_attach FROM clean GROUP BY customer_category, booked_by""")
    q["category_share_by_package"] = sql(f"""
SELECT package_code, COUNT(*) AS bookings, {share("customer_category = 'vip gold'")} AS category_share
FROM clean GROUP BY package_code""")
    q["isolated_kind_margin"] = sql(f"""
SELECT only_kind, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum, {S('cpt_c')} AS cost_sum,
       {S('offer_c')} AS offer_sum, {PCT(S('gm_c'), S('net_c'))} AS gm_pct,
       {PCT(S('cpt_c'), S('offer_c'))} AS cost_pct_of_offer
FROM (SELECT *, CASE WHEN n_disc = 0 THEN 'none'
                     WHEN n_disc = 1 AND special_c > 0 THEN 'special' WHEN n_disc = 1 AND vip_c > 0 THEN 'vip'
                     WHEN n_disc = 1 AND coupon_c > 0 THEN 'coupon' WHEN n_disc = 1 AND redcash_c > 0 THEN 'redcash'
                     WHEN n_disc = 1 AND giftcard_c > 0 THEN 'giftcard' END AS only_kind FROM clean)
WHERE only_kind IS NOT NULL GROUP BY only_kind""")
    q["named_pair_margin"] = sql(f"""
SELECT kinds, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum, {S('cpt_c')} AS cost_sum,
       {S('offer_c')} AS offer_sum, {PCT(S('gm_c'), S('net_c'))} AS gm_pct,
       {PCT(S('cpt_c'), S('offer_c'))} AS cost_pct_of_offer
FROM (SELECT *, CASE WHEN coupon_c > 0 AND vip_c > 0 AND n_disc = 2 THEN 'coupon+vip'
                     WHEN coupon_c > 0 AND n_disc = 1 THEN 'coupon'
                     WHEN vip_c > 0 AND n_disc = 1 THEN 'vip' END AS kinds FROM clean)
WHERE kinds IS NOT NULL GROUP BY kinds""")
    fa = "CAST(fresh_offer AS DOUBLE) / NULLIF(fresh_n, 0)"
    ra = "CAST(repeat_offer AS DOUBLE) / NULLIF(repeat_n, 0)"
    q["aov_gap"] = sql(f"""
SELECT city, {fa} AS fresh_aov, {ra} AS repeat_aov, ({fa}) / NULLIF({ra}, 0) AS aov_gap FROM (
  SELECT city, {S("CASE WHEN booking_flag = 'Fresh' THEN offer_c END")} AS fresh_offer,
         {CNT("booking_flag = 'Fresh'")} AS fresh_n,
         {S("CASE WHEN NOT (booking_flag = 'Fresh') THEN offer_c END")} AS repeat_offer,
         {CNT("NOT (booking_flag = 'Fresh')")} AS repeat_n
  FROM clean GROUP BY city)""")
    q["settlement_curve"] = sql(f"""
SELECT booking_month, months_to_collect, bookings,
       {PCT("bookings", "SUM(bookings) OVER (PARTITION BY booking_month)")} AS share_pct,
       {PCT("SUM(bookings) OVER (PARTITION BY booking_month ORDER BY months_to_collect ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
            "SUM(bookings) OVER (PARTITION BY booking_month)")} AS cum_share_pct
FROM (SELECT CAST(date_trunc('month', booking_date) AS DATE) AS booking_month,
             CAST(date_diff('month', CAST(date_trunc('month', booking_date) AS DATE),
                            CAST(date_trunc('month', collection_date) AS DATE)) AS INTEGER) AS months_to_collect,
             COUNT(*) AS bookings FROM bookings GROUP BY 1, 2)""")
    q["daily_completeness"] = sql("""
SELECT booking_date, rows, null_gm_rows, CAST(null_gm_rows AS DOUBLE) / NULLIF(rows, 0) AS null_gm_share,
       rows / (SELECT quantile_cont(rows, 0.5) FROM d) AS rows_vs_median, null_gm_rows = 0 AS settled FROM d""",
                                  """d AS (SELECT booking_date, COUNT(*) AS rows,
  CAST(SUM(CASE WHEN gm_c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_gm_rows FROM bookings GROUP BY booking_date)""")
    return q
