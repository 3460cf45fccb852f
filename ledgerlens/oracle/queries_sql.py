"""All oracle SQL, keyed like ``queries()``."""

from __future__ import annotations

from . import rollups_sql
from .sql_common import sql


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q.update(rollups_sql.queries())
    q["file_manifest"] = sql("""
SELECT source_file, rows, collection_date_min, collection_date_max, collection_months, n_months, booking_date_min,
       booking_date_max, booking_id_min, booking_id_max,
       CASE WHEN n_months > 1 THEN 'spans several months' ELSE '' END AS note FROM manifest""")
    q["derive_clean_window"] = sql("SELECT clean_start, clean_end FROM win")
    q["settled_rows"] = sql("""
SELECT COUNT(*) AS rows_total, CAST(SUM(CASE WHEN gm_c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_unsettled,
       CAST(SUM(CASE WHEN gm_c IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS rows_settled FROM bookings""")
    from . import coupons_sql, pricing_sql, quality_sql, segments_sql, trends_sql
    q.update(quality_sql.queries())
    q.update(pricing_sql.queries())
    q.update(coupons_sql.queries())
    q.update(segments_sql.queries())
    q.update(trends_sql.queries())
    try:
        from . import more_sql
        q.update(more_sql.queries())
    except ImportError:
        pass
    return q
