"""Ranks over a whole result without ranking it in one task.

The rows are range-partitioned on (group, value, id) and kept with the number of their range, so
a range is one stretch of the sorted result; the id parts rows of equal value, so a value that a
third of all rows share is cut, too. Ranks inside a range come from a window over the range; one row
for each range (its size, first and last value) gives what lies before it. A run of equal values that
started in an earlier range keeps the rank of its first row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _sortable(value: str, ascending: bool) -> tuple[Column, Column]:
    """(null flag, value) that sort ascending with nulls first, or descending with nulls last."""
    c = F.col(value).cast("double")
    zero = F.lit(0.0)
    if ascending:
        return F.col(value).isNotNull(), F.coalesce(c + zero, zero)
    return F.col(value).isNull(), F.coalesce(zero - c, zero)


def ranked(df: DataFrame, group: list[str], value: str, ids: list[str], rank: str, ascending: bool = True,
           total: str | None = None) -> DataFrame:
    """``df`` with the column ``rank``: that of ``value`` inside the group, as SQL's RANK gives it
    (ties share the rank of the first; nulls first when ascending, last when descending), and with
    ``total`` the size of the group. ``ids`` part rows of equal value; values rank as doubles."""
    flag, order = _sortable(value, ascending)
    return _ranked(df.withColumn("_flag", flag).withColumn("_order", order), group, ids, rank, total)


def _ranked(df: DataFrame, group: list[str], ids: list[str], rank: str, total: str | None) -> DataFrame:
    """Ranks by the columns _flag and _order, which have no nulls."""
    checkpoint_dir(df.sparkSession)
    rows = (df.repartitionByRange(*group, "_flag", "_order", *ids).withColumn("_range", F.spark_partition_id())
            .checkpoint())  # a row's range is fixed here: the windows below must all see the same cuts
    keys = [*group, "_range"]
    rows = rows.withColumn("_inside", F.rank().over(Window.partitionBy(*keys).orderBy("_flag", "_order")))
    place = F.struct("_flag", "_order")
    # one row a range from here on, and one exchange for both windows: what is before the range, and
    # how much of that ties with its first value (its own last value: all rows from that one's rank on)
    ranges = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_lo"), F.max(place).alias("_hi"),
                                     F.max("_inside").alias("_last")).repartition(*[F.col(g) for g in group])
    along = Window.partitionBy(*group).orderBy("_range")
    same_last = Window.partitionBy(*group, "_hi").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumn("_run", F.struct("_hi", F.sum(F.col("_n") - F.col("_last") + 1).over(same_last).alias("n")))
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lag("_run").over(along)
    ties = F.when(last._hi == F.col("_lo"), last.n).otherwise(F.lit(0))
    ranges = ranges.select(*[F.col(g).alias(f"_of_{g}") for g in group], F.col("_range").alias("_at"), "_lo",
                           before.alias("_before"), ties.alias("_ties"),
                           F.sum("_n").over(Window.partitionBy(*group)).alias("_total"))
    same = F.col("_range") == F.col("_at")
    for g in group:  # a null group is a group
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    out = rows.join(ranges, same)
    first = F.when(place == F.col("_lo"), F.col("_ties")).otherwise(0)
    out = out.withColumn(rank, (F.col("_before") + F.col("_inside") - first).cast("int"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_flag", "_order", "_inside", "_range", "_at", "_lo", "_before", "_ties", "_total",
                    *[f"_of_{g}" for g in group])


def percent_ranks(df: DataFrame, ids: list[str], measures: dict[str, bool]) -> DataFrame:
    """``df`` with ``<measure>_rank`` for each measure (name -> ascending): SQL's PERCENT_RANK of
    the measure over all rows, all measures ranked in one pass. ``ids`` name a row."""
    sides = {m: _sortable(m, up) for m, up in measures.items()}
    long = df.select(*ids, F.struct(*df.columns).alias("_row"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), flag.alias("_flag"), order.alias("_order")) for m, (flag, order) in sides.items()])).alias("x"))
    each = _ranked(long.select(*ids, "_row", "x.*"), ["measure"], ids, "_rank", "_size")
    share = F.when(F.col("_size") > 1, (F.col("_rank") - 1) / (F.col("_size") - 1)).otherwise(F.lit(0.0))
    out = each.groupBy(*ids).agg(F.first("_row").alias("_row"), *[
        F.max(F.when(F.col("measure") == m, share)).alias(f"{m}_rank") for m in measures])
    return out.select("_row.*", *[f"{m}_rank" for m in measures])
