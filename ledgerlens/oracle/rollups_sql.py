"""Oracle SQL for the rollups (A01-A11, A20-A25), ingest and quality keys."""

from __future__ import annotations

from .sql_common import CNT, PCT, S, bucket, nine_sums, sql, summary_cols, top_cte

BUCKETED = """
bucketed AS (
  SELECT *,
    {pkg} AS package_bucket,
    {city} AS city_bucket,
    {coupon} AS coupon_bucket
  FROM clean
)""".format(pkg=bucket("package_code", "top_pkg15"), city=bucket("city", "top_city6"),
            coupon=bucket("coupon_code", "top_coupon30", "NONE"))

TOPS = [top_cte("top_pkg15", "clean", "package_code", 15), top_cte("top_city6", "clean", "city", 6),
        top_cte("top_coupon30", "clean", "coupon_code", 30)]


def _b(body: str, *more: str) -> str:
    return sql(body, *TOPS, BUCKETED, *more)


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["booking_weekly"] = _b(f"""
SELECT week_start, package_bucket, city_bucket, {summary_cols()}
FROM bucketed GROUP BY week_start, package_bucket, city_bucket""")
    q["coupon_weekly"] = _b(f"""
SELECT week_start, coupon_bucket, {summary_cols()},
       {CNT("booking_flag = 'Repeat'")} AS repeat_bookings,
       AVG(coupon_pct) AS avg_discount_pct,
       {PCT(CNT("booking_flag = 'Repeat'"), "COUNT(*)")} AS repeat_share
FROM bucketed GROUP BY week_start, coupon_bucket""")
    q["package_info"] = sql("""
SELECT package_code, COUNT(*) AS bookings,
       CASE WHEN COALESCE(contains(package_code, ','), FALSE) THEN 'combo booking' ELSE '' END AS note
FROM clean WHERE package_code IS NOT NULL GROUP BY package_code
ORDER BY COUNT(*) DESC, package_code ASC LIMIT 80""")
    q["segment_weekly"] = _b(f"""
SELECT week_start, customer_category, booking_flag, city_bucket, {summary_cols(True)}
FROM bucketed GROUP BY week_start, customer_category, booking_flag, city_bucket""")
    q["channel_weekly"] = _b(f"""
SELECT week_start, booked_by, city_bucket, {summary_cols()}, AVG(total_disc_pct) AS avg_discount_pct
FROM bucketed GROUP BY week_start, booked_by, city_bucket""")
    q["stacking_weekly"] = sql(f"""
SELECT week_start, n_disc_types, {summary_cols()} FROM (
  SELECT *, CASE WHEN nk >= 3 THEN '3+' ELSE CAST(nk AS VARCHAR) END AS n_disc_types FROM (
    SELECT *, CAST(COALESCE(special_c, 0) <> 0 AS INTEGER) + CAST(COALESCE(vip_c, 0) <> 0 AS INTEGER)
            + CAST(COALESCE(coupon_c, 0) <> 0 AS INTEGER) + CAST(COALESCE(redcash_c, 0) <> 0 AS INTEGER)
            + CAST(COALESCE(giftcard_c, 0) <> 0 AS INTEGER) AS nk FROM clean))
GROUP BY week_start, n_disc_types""")
    q["geo_weekly"] = sql(f"""
SELECT week_start, city, zone, {summary_cols(True)} FROM (
  SELECT week_start, gm_c, net_c, offer_c, {bucket("city", "top_city20")} AS city,
         {bucket("zone", "top_zone30")} AS zone FROM clean)
GROUP BY week_start, city, zone""", top_cte("top_city20", "clean", "city", 20),
                          top_cte("top_zone30", "clean", "zone", 30))
    q["daily_trend"] = sql(f"""
SELECT booking_date, package_bucket, city_bucket, {summary_cols()},
       NOT (booking_date BETWEEN (SELECT clean_start FROM win) AND (SELECT clean_end FROM win)) AS is_partial
FROM (SELECT *, {bucket("package_code", "top_pkg15")} AS package_bucket, {bucket("city", "top_city6")} AS city_bucket
      FROM settled WHERE booking_date >= (SELECT clean_start FROM win))
GROUP BY booking_date, package_bucket, city_bucket""", *TOPS[:2])
    q["weekly_waterfall"] = sql(f"""
SELECT week_start, is_partial, COUNT(*) AS bookings, {nine_sums()}, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
FROM clean GROUP BY week_start, is_partial""")
    q["package_gm"] = sql(f"""
SELECT package_code, {summary_cols(True)}, COALESCE(contains(package_code, ','), FALSE) AS is_combo FROM (
  SELECT c.gm_c, c.net_c, c.offer_c, COALESCE(k.package_code, 'OTHER') AS package_code
  FROM clean c LEFT JOIN (SELECT package_code FROM clean GROUP BY package_code HAVING COUNT(*) >= 10) k
    ON c.package_code IS NOT DISTINCT FROM k.package_code)
GROUP BY package_code""")
    q["booking_cube_weekly"] = sql(f"""
SELECT week_start, package_bucket, city_bucket, customer_category, booking_flag, {summary_cols(True)},
       {S('cpt_c')} AS cost_sum, AVG(total_disc_pct) AS avg_total_disc_pct
FROM (SELECT *, {bucket("package_code", "top_pkg80")} AS package_bucket,
             {bucket("city", "top_city15")} AS city_bucket FROM clean)
GROUP BY week_start, package_bucket, city_bucket, customer_category, booking_flag""",
                                   top_cte("top_pkg80", "clean", "package_code", 80),
                                   top_cte("top_city15", "clean", "city", 15))
    ns = f"COUNT(*) AS bookings, {nine_sums()}, {PCT(S('gm_c'), S('net_c'))} AS gm_pct"
    q["weekly_market_sku"] = sql(f"""
SELECT week_start, is_partial, market, sku, {ns} FROM settled GROUP BY week_start, is_partial, market, sku""")
    q["weekly_stack"] = sql(f"""
SELECT week_start, is_partial, n_disc_types, tier, {ns} FROM (
  SELECT *, CASE WHEN n_disc >= 3 THEN '3+' ELSE CAST(n_disc AS VARCHAR) END AS n_disc_types,
         customer_category AS tier FROM settled)
GROUP BY week_start, is_partial, n_disc_types, tier""")
    q["weekly_coupon"] = sql(f"""
SELECT week_start, is_partial, coupon, {ns},
       {CNT("booking_flag = 'Repeat'")} AS repeat_bookings, {CNT("n_disc >= 3")} AS bookings_3plus,
       {CNT("gm_c < 0")} AS bookings_negative_gm
FROM (SELECT *, COALESCE(coupon_code, 'NONE') AS coupon FROM settled)
GROUP BY week_start, is_partial, coupon""")
    q["weekly_segment"] = sql(f"""
SELECT week_start, is_partial, market, tier, flag, channel, {ns} FROM (
  SELECT *, customer_category AS tier, booking_flag AS flag, booked_by AS channel FROM settled)
GROUP BY week_start, is_partial, market, tier, flag, channel""")
    q["stack_distribution"] = sql(f"""
SELECT n_disc_types, bookings, net_sum, gm_sum, {PCT("bookings", "SUM(bookings) OVER ()")} AS share_pct,
       {PCT("gm_sum", "net_sum")} AS gm_pct FROM (
  SELECT CASE WHEN n_disc >= 3 THEN '3+' ELSE CAST(n_disc AS VARCHAR) END AS n_disc_types,
         COUNT(*) AS bookings, {S('net_c')} AS net_sum, {S('gm_c')} AS gm_sum
  FROM settled WHERE NOT is_partial GROUP BY 1)""")
    q["negative_margin_tail"] = sql(f"""
SELECT COALESCE(coupon_code, 'NONE') AS coupon, COUNT(*) AS bookings,
       {CNT("gm_c < 0")} AS negative_gm_bookings,
       {S("CASE WHEN gm_c < 0 THEN gm_c END")} AS gm_lost_on_negative,
       {PCT(CNT("gm_c < 0"), "COUNT(*)")} AS negative_gm_share_pct
FROM settled WHERE NOT is_partial GROUP BY 1""")
    return q
