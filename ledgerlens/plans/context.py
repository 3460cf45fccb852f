"""Per-(session, dataset) context: the prepared bookings, derived window and buckets.

Scalars that parameterise many queries (the clean window) are computed once as a
one-row aggregate and passed on as literals, so the date filter reaches the Parquet
scan as a pushed predicate instead of a join.
"""

from __future__ import annotations

import datetime as _dt
import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..operators import prepare as PR
from ..operators import quality as Q
from ..sources.bookings import bookings, dataset_uri

_LOCK = threading.Lock()
_CTX: dict = {}


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str, window: P.WindowParams | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._window = window or P.WindowParams()
        self._tops: dict = {}

    @property
    def _fact(self) -> DataFrame:
        return bookings(self.spark, self.sf_dir)

    @property
    def bookings(self) -> DataFrame:
        """The fact with ``is_partial``: its week is not wholly inside the covered days."""
        return PR.flag_partial_weeks(self._fact, *self.covered)

    @property
    def settled(self) -> DataFrame:
        return PR.settled_rows(self.bookings)

    def manifest(self) -> DataFrame:
        return Q.file_manifest(self._fact)

    @cached_property
    def covered(self) -> tuple[_dt.date, _dt.date]:
        """First day with bookings inside the clean window, and the clean end."""
        start, end = self.window
        first = self._fact.agg(F.min("booking_date").alias("d")).first()["d"]
        return max(d for d in (start, first) if d is not None) if start or first else start, end

    @cached_property
    def window(self) -> tuple[_dt.date, _dt.date]:
        if self._window.start and self._window.end:
            return self._window.start, self._window.end
        row = Q.derive_clean_window(self.manifest()).first()
        return (self._window.start or row["clean_start"], self._window.end or row["clean_end"])

    @property
    def clean(self) -> DataFrame:
        start, end = self.window
        return PR.clean_window(self.settled, start, end)

    def top(self, key: str, n: int) -> DataFrame:
        """Top-n values of ``key`` on the clean window, learned once per context and cached
        (at most n rows; recomputed from lineage if an executor holding it is lost)."""
        k = (key, n)
        with _LOCK:
            if k not in self._tops:
                self._tops[k] = PR.top_values(self.clean, key, n).cache()
            return self._tops[k]

    @cached_property
    def top_agents(self) -> DataFrame:
        """The busiest sales agents on the clean window (at most N rows), cached like ``top``."""
        return PR.top_values(self.clean.filter(F.col("booked_by") == "Sales"), "agent_id", P.TOP_N["agent20"]).cache()

    @cached_property
    def panel(self) -> DataFrame:
        """Complete-week bookings per (week, market, sku), shared by the DiD-based keys and
        cached once per context. Its size is bounded by weeks x markets x skus, not by the
        number of bookings; a lost executor recomputes its blocks from lineage."""
        from ..operators.pricing import weekly_panel
        with _LOCK:
            return weekly_panel(self.settled).cache()

    @cached_property
    def daily_cells(self) -> DataFrame:
        """Clean-window bookings and sums per (day, sku, market), shared by the event-window
        keys and cached once per context (bounded by days x skus x markets)."""
        from ..operators.pricing import daily_cells
        with _LOCK:
            return daily_cells(self.clean).cache()

    def bucketed(self, *which: str) -> DataFrame:
        """Clean rows with the long-tail buckets the caller uses (``package``, ``city``,
        ``coupon``; all three by default), top-N learned on the clean window. Only the
        requested (broadcast) bucket joins are planned."""
        which = which or ("package", "city", "coupon")
        out = self.clean
        if "package" in which:
            out = PR.bucket_by_top(out, self.top("package_code", P.TOP_N["package15"]), "package_code",
                                   "package_bucket")
        if "city" in which:
            out = PR.bucket_by_top(out, self.top("city", P.TOP_N["city6"]), "city", "city_bucket")
        if "coupon" in which:
            out = PR.bucket_by_top(out, self.top("coupon_code", P.TOP_N["coupon30"]), "coupon_code",
                                   "coupon_bucket", null_label=P.NONE_COUPON)
        return out


class FrameContext(Context):
    """Context over a prepared fact given as a DataFrame (for example from extracts)."""

    def __init__(self, spark: SparkSession, fact: DataFrame, window: P.WindowParams | None = None):
        super().__init__(spark, "", window)
        self._frame = fact

    @property
    def _fact(self) -> DataFrame:
        return self._frame


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, dataset_uri(spark, sf_dir))
    with _LOCK:
        if key not in _CTX:
            _CTX[key] = Context(spark, sf_dir)
        return _CTX[key]
