"""Oracle SQL for the ranking, week-over-week and trend keys."""

from __future__ import annotations

from .sql_common import CNT, PCT, S, nine_sums, sql

LINES = ["bookings", "offer_sum", "special_sum", "vip_sum", "coupon_sum", "redcash_sum", "giftcard_sum", "net_sum",
         "cpt_sum", "gm_sum"]
WF = f"wf AS (SELECT week_start, is_partial, COUNT(*) AS bookings, {nine_sums()} FROM clean GROUP BY week_start, is_partial)"
WFL = ("wfl AS (" + " UNION ALL ".join(
    f"SELECT week_start, is_partial, '{ln}' AS line, {ln} AS value FROM wf" for ln in LINES) + ")")
WOW = f"""wow AS (
  SELECT week_start, line, value, prev_value, value - prev_value AS abs_delta,
         {PCT("value - prev_value", "prev_value")} AS pct_delta,
         is_partial OR COALESCE(prev_partial, FALSE) AS vs_partial
  FROM (SELECT *, LAG(value) OVER (PARTITION BY line ORDER BY week_start) AS prev_value,
               LAG(is_partial) OVER (PARTITION BY line ORDER BY week_start) AS prev_partial FROM wfl))"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["top5_coupon_by_category"] = sql("""
SELECT * FROM (SELECT customer_category, coupon_code, n,
                      ROW_NUMBER() OVER (PARTITION BY customer_category ORDER BY n DESC, coupon_code ASC) AS rank
               FROM (SELECT customer_category, coupon_code, COUNT(*) AS n FROM clean WHERE coupon_c > 0
                     GROUP BY customer_category, coupon_code)) WHERE rank <= 5""")
    q["revenue_share"] = sql(f"""
SELECT city, revenue, {PCT("revenue", "SUM(revenue) OVER ()")} AS share_pct
FROM (SELECT city, {S('net_c')} AS revenue FROM clean GROUP BY city)""")
    q["wow_delta"] = sql("SELECT * FROM wow", WF, WFL, WOW)
    q["favourability"] = sql("""
SELECT week_start, line, abs_delta,
       CASE WHEN abs_delta IS NULL THEN NULL WHEN abs_delta = 0 THEN 'flat'
            WHEN (line IN ('bookings', 'offer_sum', 'net_sum', 'gm_sum') AND abs_delta > 0)
              OR (line NOT IN ('bookings', 'offer_sum', 'net_sum', 'gm_sum') AND abs_delta < 0) THEN 'good'
            ELSE 'bad' END AS favourability, vs_partial FROM wow""", WF, WFL, WOW)
    q["biggest_mover"] = sql("""
SELECT week_start, line, pct_delta FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY week_start ORDER BY abs(pct_delta) DESC, line ASC) AS rn FROM wow
  WHERE line IN ('special_sum', 'vip_sum', 'coupon_sum', 'redcash_sum', 'giftcard_sum') AND pct_delta IS NOT NULL
    AND NOT vs_partial)
WHERE rn = 1""", WF, WFL, WOW)
    q["trailing_gm"] = sql(f"""
SELECT week_start, trailing_gm, trailing_net, weeks_in_window, {PCT("trailing_gm", "trailing_net")} AS trailing_gm_pct
FROM (SELECT week_start,
             CAST(SUM(gm) OVER w AS BIGINT) AS trailing_gm, CAST(SUM(net) OVER w AS BIGINT) AS trailing_net,
             COUNT(*) OVER w AS weeks_in_window
      FROM (SELECT week_start, {S('gm_c')} AS gm, {S('net_c')} AS net FROM clean WHERE NOT is_partial
            GROUP BY week_start)
      WINDOW w AS (ORDER BY week_start RANGE BETWEEN INTERVAL 49 DAYS PRECEDING AND CURRENT ROW))""")
    kinds = ("special", "vip", "coupon", "redcash", "giftcard")
    by_kind = " UNION ALL ".join(
        f"SELECT '{k}_sum' AS line, week_start, {S(f'{k}_c')} AS value, {S('offer_c')} AS offer "
        "FROM clean WHERE NOT is_partial GROUP BY week_start" for k in kinds)
    q["trailing_gm_by_kind"] = sql(f"""
SELECT *, {PCT("trailing_value", "trailing_offer")} AS trailing_pct_of_offer FROM (
  SELECT line, week_start, value, CAST(SUM(value) OVER w AS BIGINT) AS trailing_value,
         CAST(SUM(offer) OVER w AS BIGINT) AS trailing_offer, COUNT(*) OVER w AS weeks_in_window
  FROM ({by_kind})
  WINDOW w AS (PARTITION BY line ORDER BY week_start RANGE BETWEEN INTERVAL 35 DAYS PRECEDING AND CURRENT ROW))""")
    lines = [ln for ln in LINES if ln not in ("bookings", "offer_sum")]
    q["pct_of_offer"] = sql(" UNION ALL ".join(
        f"SELECT week_start, '{ln}' AS line, {ln} AS value, {PCT(ln, 'offer_sum')} AS pct_of_offer FROM wf"
        for ln in lines), WF)
    q["wow_scorecard"] = sql(f"""
SELECT week_start, metric, value, prev_value, value - prev_value AS delta,
       {PCT("value - prev_value", "prev_value")} AS pct_delta,
       is_partial OR COALESCE(prev_partial, FALSE) AS vs_partial
FROM (SELECT *, LAG(value) OVER (PARTITION BY metric ORDER BY week_start) AS prev_value,
             LAG(is_partial) OVER (PARTITION BY metric ORDER BY week_start) AS prev_partial FROM (
  SELECT week_start, is_partial, 'bookings' AS metric, bookings AS value FROM wk UNION ALL
  SELECT week_start, is_partial, 'gm_sum', gm_sum FROM wk UNION ALL
  SELECT week_start, is_partial, 'revenue_sum', revenue_sum FROM wk UNION ALL
  SELECT week_start, is_partial, 'gm_pct', gm_pct FROM wk))""",
                             f"""wk AS (SELECT week_start, is_partial, CAST(COUNT(*) AS DOUBLE) AS bookings,
  CAST({S('gm_c')} AS DOUBLE) AS gm_sum, CAST({S('net_c')} AS DOUBLE) AS revenue_sum,
  {PCT(f"CAST({S('gm_c')} AS DOUBLE)", f"CAST({S('net_c')} AS DOUBLE)")} AS gm_pct
  FROM clean GROUP BY week_start, is_partial)""")
    q["fresh_share_trend"] = sql(f"""
SELECT week_start, is_partial, {CNT("booking_flag = 'Fresh'")} AS fresh, COUNT(*) AS total,
       {PCT(CNT("booking_flag = 'Fresh'"), "COUNT(*)")} AS fresh_share
FROM clean WHERE customer_category = 'vip gold' GROUP BY week_start, is_partial""")
    ft = (f"COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum, "
          f"{PCT(S('gm_c'), S('net_c'))} AS gm_pct, {S('offer_c')} / COUNT(*) AS aov")
    q["fresh_repeat_trend"] = sql(f"SELECT week_start, is_partial, booking_flag, {ft} FROM clean GROUP BY 1, 2, 3")
    q["fresh_repeat_by_category"] = sql(
        f"SELECT week_start, is_partial, booking_flag, customer_category, {ft} FROM clean GROUP BY 1, 2, 3, 4")
    q["lifecycle_curve"] = sql("""
SELECT coupon_code, week_start, bookings,
       CAST(date_diff('day', MIN(week_start) OVER (PARTITION BY coupon_code), week_start) / 7 AS INTEGER)
         AS weeks_since_first
FROM (SELECT coupon_code, week_start, COUNT(*) AS bookings FROM clean WHERE coupon_code IS NOT NULL GROUP BY 1, 2)""")
    q["city_aov_outlier"] = sql("""
SELECT city, bookings, aov, m AS median_aov, aov / m AS aov_vs_median,
       (aov / m > 1.25) OR (aov / m < 1.0 / 1.25) AS is_outlier
FROM g, (SELECT quantile_cont(aov, 0.5) AS m FROM g)""",
                                f"""g AS (SELECT city, COUNT(*) AS bookings, {S('offer_c')} AS offer_sum,
  {S('offer_c')} / COUNT(*) AS aov FROM clean GROUP BY city)""")
    q["geo_ranking"] = sql(f"""
SELECT *, RANK() OVER (PARTITION BY level ORDER BY gm_pct DESC NULLS LAST) AS rank FROM (
  SELECT name, gm_sum, revenue_sum, level, {PCT("gm_sum", "revenue_sum")} AS gm_pct FROM (
    SELECT city AS name, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum, 'city' AS level FROM clean GROUP BY city
    UNION ALL
    SELECT zone, {S('gm_c')}, {S('net_c')}, 'zone' FROM clean GROUP BY zone))""")
    q["package_ranking"] = sql(f"""
SELECT *, RANK() OVER (PARTITION BY is_combo ORDER BY gm_pct DESC NULLS LAST) AS rank_in_kind FROM (
  SELECT package_code, COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum,
         {PCT(S('gm_c'), S('net_c'))} AS gm_pct, COALESCE(contains(package_code, ','), FALSE) AS is_combo
  FROM clean GROUP BY package_code)""")
    return q
