"""Shared SQL fragments for the oracle queries (DuckDB dialect)."""

from __future__ import annotations

from .bookings_sql import BOOKINGS_CTE

MANIFEST_CTE = """
manifest AS (
  SELECT source_file,
         COUNT(*) AS rows,
         MIN(collection_date) AS collection_date_min,
         MAX(collection_date) AS collection_date_max,
         string_agg(DISTINCT strftime(collection_date, '%Y-%m'), ',' ORDER BY strftime(collection_date, '%Y-%m'))
           AS collection_months,
         CAST(COUNT(DISTINCT strftime(collection_date, '%Y-%m')) AS INTEGER) AS n_months,
         MIN(booking_date) AS booking_date_min,
         MAX(booking_date) AS booking_date_max,
         MIN(booking_id) AS booking_id_min,
         MAX(booking_id) AS booking_id_max
  FROM bookings GROUP BY source_file
),
win AS (
  SELECT MIN(CASE WHEN n_months = 1 THEN CAST(date_trunc('month', collection_date_min) AS DATE) END) AS clean_start,
         last_day(CAST(CAST(date_trunc('month', MAX(collection_date_max)) AS DATE) - INTERVAL 1 MONTH AS DATE))
           AS clean_end
  FROM manifest
),
settled AS (SELECT * FROM bookings WHERE gm_c IS NOT NULL),
clean AS (
  SELECT s.* FROM settled s, win WHERE s.booking_date BETWEEN win.clean_start AND win.clean_end
)"""


def S(x: str) -> str:
    """Sum in cents that is 0 over only-missing rows."""
    return f"CAST(COALESCE(SUM({x}), 0) AS BIGINT)"


def CNT(pred: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {pred} THEN 1 ELSE 0 END), 0) AS BIGINT)"


def PCT(num: str, den: str) -> str:
    return f"100e0 * ({num}) / NULLIF({den}, 0)"


def top_cte(name: str, src: str, key: str, n: int) -> str:
    return (f"{name} AS (SELECT {key} AS k FROM {src} WHERE {key} IS NOT NULL GROUP BY {key} "
            f"ORDER BY COUNT(*) DESC, {key} ASC LIMIT {n})")


def bucket(key: str, top: str, null_label: str | None = None) -> str:
    expr = f"CASE WHEN {key} IN (SELECT k FROM {top}) THEN {key} ELSE 'OTHER' END"
    if null_label:
        expr = f"CASE WHEN {key} IS NULL THEN '{null_label}' ELSE {expr} END"
    return expr


def sql(body: str, *ctes: str) -> str:
    parts = [BOOKINGS_CTE.strip(), MANIFEST_CTE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


NINE = [("offer_c", "offer_sum"), ("special_c", "special_sum"), ("vip_c", "vip_sum"), ("coupon_c", "coupon_sum"),
        ("redcash_c", "redcash_sum"), ("giftcard_c", "giftcard_sum"), ("net_c", "net_sum"), ("cpt_c", "cpt_sum"),
        ("gm_c", "gm_sum")]


def nine_sums() -> str:
    return ", ".join(f"{S(c)} AS {a}" for c, a in NINE)


def summary_cols(with_offer: bool = False) -> str:
    cols = (f"COUNT(*) AS bookings, {S('gm_c')} AS gm_sum, {S('net_c')} AS revenue_sum, "
            f"{PCT(S('gm_c'), S('net_c'))} AS gm_pct")
    if with_offer:
        cols += f", {S('offer_c')} / COUNT(*) AS asp"
    return cols
