"""The ``bookings`` mapping and small dimensions written as plain SQL (DuckDB dialect).

This is the independent side of the correctness check: the Spark jobs build the same
fact with the DataFrame API, these CTEs rebuild it from the raw tables inside DuckDB.
"""

from __future__ import annotations

from .. import params as P

BOOKINGS_CTE = """
ord_rank AS (
  SELECT o_orderkey,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders
),
ord AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, c.c_mktsegment, n.n_name, r.r_name,
         orr.rn <= 3 AS is_fresh
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
  JOIN ord_rank orr ON orr.o_orderkey = o.o_orderkey
),
bk1 AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus,
         o.o_custkey, o.o_orderpriority, o.n_name, o.r_name, o.is_fresh, p.p_type, p.p_retailprice,
         CAST(o.o_orderdate AS DATE) AS booking_date,
         CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS BIGINT) AS offer_c,
         CAST(FLOOR(l.l_discount * 100 + 0.5) AS INTEGER) AS disc_pt,
         CAST(FLOOR(l.l_tax * 100 + 0.5) AS INTEGER) AS tax_pt,
         l.l_discount > 0.005 AS has_coupon,
         CASE WHEN o.c_mktsegment = 'AUTOMOBILE' THEN 'vip gold'
              WHEN o.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'vip' ELSE 'regular' END AS customer_category,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Self'
              WHEN o.o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'Sales' ELSE 'Phlebo' END AS booked_by
  FROM lineitem l
  JOIN ord o ON o.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey
),
bk2 AS (
  SELECT *,
         CASE WHEN has_coupon THEN CAST(FLOOR(offer_c * (disc_pt * 4) / 100e0) AS BIGINT) ELSE 0 END AS coupon_c,
         CASE WHEN has_coupon THEN disc_pt * 4 ELSE 0 END AS coupon_pct,
         CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN CAST(FLOOR(offer_c * 5 / 100e0) AS BIGINT) ELSE 0 END
           AS special_c,
         CASE WHEN tax_pt % 3 = 0 THEN 0
              WHEN customer_category = 'vip gold' THEN CAST(FLOOR(offer_c * 15 / 100e0) AS BIGINT)
              WHEN customer_category = 'vip' THEN CAST(FLOOR(offer_c * 10 / 100e0) AS BIGINT) ELSE 0 END AS vip_c,
         CASE WHEN tax_pt % 3 = 0 THEN 0 WHEN customer_category = 'vip gold' THEN 15
              WHEN customer_category = 'vip' THEN 10 ELSE 0 END AS vip_pt,
         CASE WHEN l_orderkey % 17 = 0 THEN CAST(FLOOR(offer_c * 3 / 100e0) AS BIGINT) ELSE 0 END AS redcash_c,
         CASE WHEN l_orderkey % 23 = 0 THEN CAST(FLOOR(offer_c * 10 / 100e0) AS BIGINT) ELSE 0 END AS giftcard_c
  FROM bk1
),
bk3 AS (
  SELECT *,
         CAST(special_c > 0 AS INTEGER) + CAST(vip_c > 0 AS INTEGER) + CAST(coupon_c > 0 AS INTEGER)
           + CAST(redcash_c > 0 AS INTEGER) + CAST(giftcard_c > 0 AS INTEGER) AS n_disc,
         offer_c - special_c - vip_c - coupon_c - redcash_c - giftcard_c AS net_c
  FROM bk2
),
bk4 AS (
  SELECT *, CAST(FLOOR(offer_c * (18 + l_partkey % 20 + 5 * LEAST(n_disc, 3)) / 100e0) AS BIGINT) AS cpt_c
  FROM bk3
),
bookings_base AS (
  SELECT
    l_orderkey * 10 + l_linenumber AS booking_id,
    booking_date,
    booking_date + CAST(l_partkey % 45 AS INTEGER) AS collection_date,
    'PL' || CAST(l_partkey % 200 AS VARCHAR)
      || CASE WHEN l_linenumber = 7 THEN ',PL' || CAST(l_suppkey % 10 AS VARCHAR) ELSE '' END AS package_code,
    CASE WHEN has_coupon THEN 'CPN' || CAST(disc_pt * 4 AS VARCHAR) || '_' || CAST(l_suppkey % 6 AS VARCHAR) END
      AS coupon_code,
    n_name AS city, r_name AS market, p_type AS sku,
    'Z' || CAST(l_suppkey % 100 AS VARCHAR) AS zone,
    customer_category,
    CASE WHEN is_fresh THEN 'Fresh' ELSE 'Repeat' END AS booking_flag,
    booked_by,
    CASE WHEN booked_by = 'Sales' THEN 'AG' || CAST(o_custkey % 40 AS VARCHAR) END AS agent_id,
    1 + CAST(l_quantity AS INTEGER) % 4 AS total_member,
    p_retailprice >= 950 AS is_premium,
    offer_c, coupon_pct, special_c, vip_c, coupon_c, redcash_c, giftcard_c,
    CAST(CASE WHEN l_linenumber = 2 THEN 4900 ELSE 0 END AS BIGINT) AS express_fee_c,
    CAST(CASE WHEN l_partkey % 7 = 0 THEN 2500 ELSE 0 END AS BIGINT) AS hardcopy_fee_c,
    n_disc,
    coupon_pct + vip_pt + CASE WHEN special_c > 0 THEN 5 ELSE 0 END + CASE WHEN redcash_c > 0 THEN 3 ELSE 0 END
      + CASE WHEN giftcard_c > 0 THEN 10 ELSE 0 END AS total_disc_pct,
    net_c, cpt_c,
    CASE WHEN l_linestatus = 'O' AND booking_date >= DATE '2001-07-01' THEN NULL ELSE net_c - cpt_c END AS gm_c,
    CASE WHEN l_orderkey % 31 = 0 THEN 'n/a' ELSE CAST(cpt_c AS VARCHAR) END AS cpt_raw,
    CAST(date_trunc('week', booking_date) AS DATE) AS week_start,
    'raw_' || strftime(booking_date + CAST(l_partkey % 45 AS INTEGER), '%Y-%m') AS source_file
  FROM bk4
),
base_files AS (
  SELECT MIN(collection_date) AS lo, MAX(collection_date) AS hi,
         COUNT(DISTINCT strftime(collection_date, '%Y-%m')) AS n_months
  FROM bookings_base GROUP BY source_file
),
covered AS (
  SELECT greatest(MIN(CASE WHEN n_months = 1 THEN CAST(date_trunc('month', lo) AS DATE) END),
                  (SELECT MIN(booking_date) FROM bookings_base)) AS first_day,
         last_day(CAST(CAST(date_trunc('month', MAX(hi)) AS DATE) - INTERVAL 1 MONTH AS DATE)) AS last_day
  FROM base_files
),
bookings AS (
  SELECT b.*, COALESCE(b.week_start < c.first_day OR b.week_start + 6 > c.last_day, FALSE) AS is_partial
  FROM bookings_base b, covered c
)"""


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if hasattr(v, "isoformat"):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


def values_cte(name: str, columns: list[str], rows: list[tuple], casts: dict | None = None) -> str:
    casts = casts or {}
    body = ",\n    ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    sel = ", ".join(f"CAST({c} AS {casts[c]}) AS {c}" if c in casts else c for c in columns)
    return f"{name} AS (\n  SELECT {sel} FROM (VALUES\n    {body}) AS t({', '.join(columns)})\n)"


RULE_COLUMNS = ["coupon_code", "coupon_name", "mov_c", "rule_type", "discount", "valid_once", "is_red_cash",
                "upper_limit", "created_by", "user_group", "create_date", "active"]
RULE_CASTS = {"mov_c": "BIGINT", "discount": "INTEGER", "upper_limit": "INTEGER", "create_date": "DATE",
              "user_group": "VARCHAR", "active": "VARCHAR"}


def _rule_rows(rules) -> list[tuple]:
    return [(r.code, r.name, r.mov_c, r.kind, r.discount, r.valid_once, r.is_red_cash, r.upper_limit,
             r.created_by, r.user_group, r.create_date, r.active) for r in rules]


def crm_rules_cte() -> str:
    return values_cte("crm_rules", RULE_COLUMNS, _rule_rows(P.crm_rules()), RULE_CASTS)


def rules_cte() -> str:
    """Coupon rules including the family add-on rows."""
    return values_cte("rules", RULE_COLUMNS, _rule_rows(P.crm_rules() + P.family_rules()), RULE_CASTS)


def price_events_cte() -> str:
    rows = []
    for e in P.price_events():
        for m in e.markets:
            rows.append((e.event_id, e.sku, m, e.pct, e.change_week, e.status, e.control))
    return values_cte("price_events", ["event_id", "sku", "market", "pct_change", "change_week", "status",
                                        "control_market"], rows,
                      {"pct_change": "INTEGER", "change_week": "DATE"})


def promo_events_cte() -> str:
    return values_cte("promo_events", ["week_start", "market", "event", "scope"], P.promo_events(),
                      {"week_start": "DATE"})


def price_actions_cte() -> str:
    return values_cte("price_actions", ["package_code", "package_name", "weekly_gm_delta_c",
                                         "actual_price_pct_change"], P.price_actions(),
                      {"weekly_gm_delta_c": "BIGINT", "actual_price_pct_change": "DOUBLE"})


def competitor_cte() -> str:
    return values_cte("competitor_mult", ["sku", "competitor", "mult"], P.competitor_multipliers(),
                      {"mult": "DOUBLE"})


def with_bookings(body: str, *extra_ctes: str) -> str:
    """Prefix a query with the bookings mapping (and any extra CTEs)."""
    ctes = [BOOKINGS_CTE.strip()] + [c.strip() for c in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
