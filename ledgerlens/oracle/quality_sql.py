"""Oracle SQL for the quality keys and the expression-level operators."""

from __future__ import annotations

import hashlib

from .. import params as P
from .rollups_sql import BUCKETED, TOPS
from .sql_common import CNT, PCT, S, nine_sums, sql

NDISC = ("CAST(COALESCE(special_c, 0) <> 0 AS INTEGER) + CAST(COALESCE(vip_c, 0) <> 0 AS INTEGER) "
         "+ CAST(COALESCE(coupon_c, 0) <> 0 AS INTEGER) + CAST(COALESCE(redcash_c, 0) <> 0 AS INTEGER) "
         "+ CAST(COALESCE(giftcard_c, 0) <> 0 AS INTEGER)")
DEPTH = """CASE WHEN n_disc = 0 THEN '0% - no discount'
     WHEN n_disc = 1 AND coupon_c > 0 AND offer_c <= 0 THEN 'unknown'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.1 THEN '1-10%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.2 THEN '10-20%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.3 THEN '20-30%'
     WHEN n_disc = 1 AND coupon_c > 0 AND coupon_c / offer_c < 0.4 THEN '30-40%'
     WHEN n_disc = 1 AND coupon_c > 0 THEN '40%+' END"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_window"] = sql("""
SELECT CAST(date_trunc('month', booking_date) AS DATE) AS booking_month, COUNT(*) AS rows,
       MIN(booking_date) AS first_day, MAX(booking_date) AS last_day
FROM bookings, win WHERE booking_date BETWEEN win.clean_start AND win.clean_end GROUP BY 1""")
    q["repair_cost"] = sql(f"""
SELECT COUNT(*) AS rows, {CNT("repaired")} AS rows_repaired, {CNT("fixed IS NULL")} AS rows_unrepairable,
       {S("fixed")} AS cost_fixed_sum, {CNT("fixed <> cpt_c")} AS mismatches
FROM (SELECT cpt_c, TRY_CAST(cpt_raw AS BIGINT) IS NULL AND gm_c IS NOT NULL AS repaired,
             CASE WHEN TRY_CAST(cpt_raw AS BIGINT) IS NULL AND gm_c IS NOT NULL THEN net_c - gm_c
                  ELSE TRY_CAST(cpt_raw AS BIGINT) END AS fixed FROM bookings)""")
    q["week_start"] = sql("""
SELECT CAST(date_trunc('week', booking_date) AS DATE) AS week_start, COUNT(*) AS rows,
       MIN(booking_date) AS first_day, MAX(booking_date) AS last_day FROM bookings GROUP BY 1""")
    q["discount_kinds"] = sql(f"""
SELECT n_disc_types, CASE WHEN n_disc_types >= 3 THEN '3+' ELSE CAST(n_disc_types AS VARCHAR) END AS n_disc_bucket,
       COUNT(*) AS rows FROM (SELECT {NDISC} AS n_disc_types FROM bookings) GROUP BY 1, 2""")
    q["has_coupon"] = sql(f"""
SELECT COALESCE(coupon_c > 0, FALSE) AS has_coupon, COUNT(*) AS rows, {S('coupon_c')} AS coupon_sum
FROM bookings GROUP BY 1""")
    q["coupon_depth_tier"] = sql(f"SELECT {DEPTH} AS depth_tier, COUNT(*) AS rows FROM settled GROUP BY 1")
    q["bucket_top_n"] = sql("""
SELECT 'package' AS dimension, package_bucket AS bucket, COUNT(*) AS rows FROM bucketed GROUP BY 2
UNION ALL SELECT 'city', city_bucket, COUNT(*) FROM bucketed GROUP BY 2
UNION ALL SELECT 'coupon', coupon_bucket, COUNT(*) FROM bucketed GROUP BY 2""", *TOPS, BUCKETED)
    q["bucket_min_count"] = sql(f"""
SELECT COALESCE(k.package_code, 'OTHER') AS package_bucket, COUNT(*) AS rows
FROM clean c LEFT JOIN (SELECT package_code FROM clean GROUP BY package_code
                        HAVING COUNT(*) >= {P.MIN_PACKAGE_ROWS}) k
  ON c.package_code IS NOT DISTINCT FROM k.package_code GROUP BY 1""")
    q["combo_flag"] = sql("""
SELECT COALESCE(contains(package_code, ','), FALSE) AS is_combo, COUNT(*) AS rows FROM bookings GROUP BY 1""")
    q["before_clean_start_cut"] = sql("""
SELECT NOT (booking_date BETWEEN win.clean_start AND win.clean_end) AS is_partial, COUNT(*) AS rows,
       MIN(booking_date) AS first_day, MAX(booking_date) AS last_day
FROM settled, win WHERE booking_date >= win.clean_start GROUP BY 1""")
    net = "offer_c - special_c - vip_c - coupon_c - redcash_c - giftcard_c"
    q["net_and_margin"] = sql(f"""
SELECT COUNT(*) AS rows, {CNT(f"({net}) <> net_c")} AS net_mismatch,
       {CNT(f"({net}) - cpt_c <> gm_c")} AS gm_mismatch, {CNT(f"({net}) - cpt_c < 0")} AS negative_gm,
       {CNT(f"({NDISC}) >= 3")} AS stacked_3plus FROM bookings""")
    q["complete_weeks"] = sql("SELECT DISTINCT week_start FROM settled WHERE NOT is_partial")
    q["suppress_small_n"] = sql(f"""
SELECT week_start, n_disc_types, tier, bookings,
       CASE WHEN bookings >= {P.MIN_N_FOR_PERCENTAGES} THEN gm_pct END AS gm_pct,
       CASE WHEN bookings >= {P.MIN_N_FOR_PERCENTAGES} THEN 'ok' ELSE 'insufficient data' END AS gm_pct_status
FROM (SELECT week_start, n_disc_types, tier, COUNT(*) AS bookings, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
      FROM (SELECT *, CASE WHEN n_disc >= 3 THEN '3+' ELSE CAST(n_disc AS VARCHAR) END AS n_disc_types,
                   customer_category AS tier FROM settled)
      GROUP BY week_start, is_partial, n_disc_types, tier)""")
    q["bookings_scope"] = sql(f"""
SELECT 'all' AS scope, COUNT(*) AS rows, {S('gm_c')} AS gm_sum FROM clean
UNION ALL SELECT 'vip_gold', COUNT(*), {S('gm_c')} FROM clean WHERE customer_category = 'vip gold'
UNION ALL SELECT 'sales', COUNT(*), {S('gm_c')} FROM clean WHERE booked_by = 'Sales'
UNION ALL SELECT 'coupon', COUNT(*), {S('gm_c')} FROM clean WHERE COALESCE(coupon_c > 0, FALSE)""")
    fx = repr(P.FX_RATE)
    q["currency_view"] = sql(f"""
SELECT week_start, offer_sum, net_sum, gm_sum, offer_sum * {fx}e0 / 100e0 AS offer_sum_fx,
       net_sum * {fx}e0 / 100e0 AS net_sum_fx, gm_sum * {fx}e0 / 100e0 AS gm_sum_fx
FROM (SELECT week_start, {S('offer_c')} AS offer_sum, {S('net_c')} AS net_sum, {S('gm_c')} AS gm_sum
      FROM clean GROUP BY week_start, is_partial)""")
    q["waterfall_reconcile"] = sql(f"""
SELECT week_start, offer_sum - special_sum - vip_sum - coupon_sum - redcash_sum - giftcard_sum - net_sum
         AS discount_gap_c, net_sum - cpt_sum - gm_sum AS margin_gap_c,
       (offer_sum - special_sum - vip_sum - coupon_sum - redcash_sum - giftcard_sum - net_sum) = 0
         AND (net_sum - cpt_sum - gm_sum) = 0 AS reconciles
FROM (SELECT week_start, is_partial, {nine_sums()} FROM clean GROUP BY week_start, is_partial)
WHERE NOT is_partial""")
    q["extracts_refresh"] = sql(f"""
SELECT week_start, is_partial, COUNT(*) AS bookings, {nine_sums()}, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
FROM (SELECT * REPLACE (CASE WHEN TRY_CAST(cpt_raw AS BIGINT) IS NULL AND gm_c IS NOT NULL THEN net_c - gm_c
                             ELSE TRY_CAST(cpt_raw AS BIGINT) END AS cpt_c) FROM clean)
GROUP BY week_start, is_partial""")
    q["template_waterfall"] = sql(f"""
SELECT week_start, COUNT(*) AS bookings, {nine_sums()}, {PCT(S('gm_c'), S('net_c'))} AS gm_pct
FROM (SELECT * REPLACE (net_c - cpt_c AS gm_c) FROM bookings) GROUP BY week_start""")
    q["rollup_totals_agree"] = sql("""
SELECT rollup, gm_total, ref AS waterfall_gm_total, gm_total - ref AS diff_c,
       abs(gm_total - ref) < greatest(100e0, abs(ref) * 1e-6) AS agrees
FROM t, (SELECT gm_total AS ref FROM t WHERE rollup = 'weekly_waterfall')""",
                                   f"""t AS (SELECT r AS rollup, CAST(SUM(gm) AS BIGINT) AS gm_total FROM (
  SELECT 'weekly_waterfall' AS r, {S('gm_c')} AS gm FROM settled WHERE NOT is_partial GROUP BY week_start
  UNION ALL SELECT 'weekly_stack', {S('gm_c')} FROM settled WHERE NOT is_partial
    GROUP BY week_start, CASE WHEN n_disc >= 3 THEN '3+' ELSE CAST(n_disc AS VARCHAR) END, customer_category
  UNION ALL SELECT 'weekly_coupon', {S('gm_c')} FROM settled WHERE NOT is_partial
    GROUP BY week_start, COALESCE(coupon_code, 'NONE')
  UNION ALL SELECT 'weekly_segment', {S('gm_c')} FROM settled WHERE NOT is_partial
    GROUP BY week_start, market, customer_category, booking_flag, booked_by
  UNION ALL SELECT 'weekly_market_sku', {S('gm_c')} FROM settled WHERE NOT is_partial
    GROUP BY week_start, market, sku) GROUP BY r)""")
    q["null_margin_guard"] = sql(f"""
SELECT {CNT("gm_c IS NULL")} AS null_gm_rows, COUNT(*) AS rows, {CNT("gm_c IS NULL")} = 0 AS passes
FROM bookings, win WHERE booking_date BETWEEN win.clean_start AND win.clean_end""")
    hashes = ", ".join("'" + hashlib.sha256(w.lower().encode()).hexdigest() + "'" for w in P.BANNED_WORDS)
    q["banned_tokens"] = f"""
SELECT doc_id, COUNT(*) AS hits, COUNT(DISTINCT token_hash) AS distinct_tokens FROM (
  SELECT doc_id, sha256(lower(token)) AS token_hash FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '{P.TOKEN_PATTERN}')) AS token FROM documents))
WHERE token_hash IN ({hashes}) GROUP BY doc_id"""
    q["duplicate_ids"] = sql("SELECT booking_id, COUNT(*) AS n FROM bookings GROUP BY booking_id HAVING COUNT(*) > 1")
    q["extract_disjoint"] = sql("""
SELECT booking_id, COUNT(DISTINCT source_file) AS n_files FROM bookings GROUP BY booking_id
HAVING COUNT(DISTINCT source_file) > 1""")
    q["union_extracts"] = sql(f"""
SELECT extract, COUNT(*) AS rows, {CNT("zone IS NULL")} AS rows_missing_zone, {S('gm_c')} AS gm_sum FROM (
  SELECT 'early' AS extract, zone, gm_c FROM bookings WHERE year(collection_date) < 1997
  UNION ALL SELECT 'middle', NULL, gm_c FROM bookings WHERE year(collection_date) BETWEEN 1997 AND 1999
  UNION ALL SELECT 'late', zone, gm_c FROM bookings WHERE year(collection_date) >= 2000) GROUP BY extract""")
    return q
