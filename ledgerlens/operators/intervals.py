"""Joins of dated rows with date windows by week bins.

A window is exploded to the weeks it touches, so the join is an equality on (keys, week) with the
exact dates as a residual. A dated row lies in one week and a window names a week once: each pair
meets at most once. The work grows with the windows and the rows of their weeks on either side, by
whatever strategy Spark picks from measured sizes; nothing is hinted and no pair of sides is looped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = "_week_bin"


def week_of(date: Column | str) -> Column:
    return F.date_trunc("week", date).cast("date")


def by_week(windows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """One row for each week that the closed interval [lo, hi] touches; with a null bound or hi
    before lo, one row that matches nothing, so that left joins keep the window."""
    weeks = F.when((lo.isNotNull()) & (hi >= lo), F.sequence(week_of(lo), week_of(hi), F.expr("interval 7 days")))
    return windows.withColumns({"_lo": lo, "_hi": hi}).withColumn(BIN, F.explode_outer(weeks))


def in_windows(windows: DataFrame, rows: DataFrame, keys: dict[str, str], date: str, how: str = "inner") -> DataFrame:
    """``windows`` (from ``by_week``) joined with ``rows`` on window column -> row column ``keys``
    and ``date`` inside the window. A left join keeps a window once for each of its weeks without a
    row: count a column of ``rows``. The columns of both must have different names."""
    same = (F.col(BIN) == F.col("_row_bin")) & F.col(date).between(F.col("_lo"), F.col("_hi"))
    for a, b in keys.items():
        same = same & (F.col(a) == F.col(b))
    return windows.join(rows.withColumn("_row_bin", week_of(date)), same, how).drop(BIN, "_row_bin", "_lo", "_hi")
