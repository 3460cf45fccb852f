"""The ten summary tables from one scan of the fact, checked by what the scan itself counted.

``learned_tops`` is a first scan: all top lists from one aggregate by grouping sets. ``base_aggregate``
is the second: every table's groups in one aggregate by grouping sets, with mergeable sums only, so
Spark combines in the map tasks and shuffles groups, not bookings. The tables are projections of it.

While the second scan runs, ``observe`` counts rows and sums margins before any grouping, and every
table's write counts what it writes. ``publish`` puts the tables in place only if all of it agrees;
the checks read nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import exprs as X
from ..operators import prepare as PR
from ..session import folder_of
from .context import Context

LISTS = {"package_code": "package80", "city": "city20", "coupon_code": "coupon30", "zone": "zone30"}
#: Columns of the base aggregate's groups, and the groups of each table; all but the daily table
#: are cut to the clean window.
KEYS = ["week_start", "is_partial", "in_window", "booking_date", "package_bucket", "city_bucket", "coupon_bucket",
        "city20", "zone30", "customer_category", "booking_flag", "booked_by", "n_disc_types", "package_code"]
SETS = {
    "booking_weekly": ["week_start", "in_window", "package_bucket", "city_bucket"],
    "coupon_weekly": ["week_start", "in_window", "coupon_bucket"],
    "segment_weekly": ["week_start", "in_window", "customer_category", "booking_flag", "city_bucket"],
    "channel_weekly": ["week_start", "in_window", "booked_by", "city_bucket"],
    "stacking_weekly": ["week_start", "in_window", "n_disc_types"],
    "geo_weekly": ["week_start", "in_window", "city20", "zone30"],
    "daily_trend": ["booking_date", "package_bucket", "city_bucket"],
    "weekly_waterfall": ["week_start", "is_partial", "in_window"],
    "package_gm": ["in_window", "package_code"],
}
PARTS = ["offer", "special", "vip", "coupon", "redcash", "giftcard", "net", "cpt", "gm"]
_SUMS = [f"{p}_sum" for p in PARTS]
_MORE = ["repeat_bookings", "coupon_pct_sum", "coupon_pct_n", "total_pct_sum", "total_pct_n"]


def learned_tops(clean: DataFrame) -> dict[str, list]:
    """Most frequent values of every long-tail dimension (ties by value), best first, from one
    scan; as many as the longest list asks for (a parameter), so they go to the driver."""
    dims = list(LISTS)
    counts = clean.groupingSets([[d] for d in dims], *dims).agg(F.count(F.lit(1)).alias("n"), F.grouping_id(*dims).alias("gid"))
    name = F.coalesce(*[F.when(F.col("gid") == _gid([d], dims), F.lit(d)) for d in dims])
    rows = counts.select(name.alias("dim"), F.coalesce(*[F.when(name == d, F.col(d).cast("string")) for d in dims]).alias("value"), "n")
    order = Window.partitionBy("dim").orderBy(F.desc("n"), F.asc("value"))
    most = max(P.TOP_N[k] for k in LISTS.values())
    best = rows.where("value is not null").withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    out: dict[str, list] = {d: [] for d in dims}
    for r in best.orderBy("dim", "place").collect():
        if r.place <= P.TOP_N[LISTS[r.dim]]:
            out[r.dim].append((r.value, r.n))
    return out


def _gid(columns: list[str], every: list[str]) -> int:
    """grouping_id of a set: a bit for each column that it leaves out."""
    return sum(1 << (len(every) - 1 - k) for k, c in enumerate(every) if c not in columns)


def _bucket(key: str, tops: dict[str, list], n: str, null_label: str | None = None) -> Column:
    values = [v for v, _ in tops[key][:P.TOP_N[n]]]
    label = F.when(F.col(key).isin(values), F.col(key)).otherwise(F.lit(P.OTHER))
    return label if null_label is None else F.when(F.col(key).isNull(), F.lit(null_label)).otherwise(label)


def base_aggregate(rows: DataFrame, tops: dict[str, list], start, end) -> DataFrame:
    """Every table's groups (``gid`` tells which) with counts and sums; ``rows`` are settled."""
    df = rows.withColumns({
        "in_window": F.col("booking_date").between(F.lit(start), F.lit(end)),
        "package_bucket": _bucket("package_code", tops, "package15"), "city_bucket": _bucket("city", tops, "city6"),
        "coupon_bucket": _bucket("coupon_code", tops, "coupon30", P.NONE_COUPON),
        "city20": _bucket("city", tops, "city20"), "zone30": _bucket("zone", tops, "zone30"),
        "n_disc_types": X.stack_bucket(X.n_disc_types(True))})
    money = [X.sum0(f"{p}_c").alias(f"{p}_sum") for p in PARTS]
    return df.groupingSets(list(SETS.values()), *KEYS).agg(
        F.grouping_id(*KEYS).alias("gid"), F.count(F.lit(1)).alias("bookings"), *money,
        X.count_when(F.col("booking_flag") == P.REPEAT).alias("repeat_bookings"),
        F.sum("coupon_pct").alias("coupon_pct_sum"), F.count("coupon_pct").alias("coupon_pct_n"),
        F.sum("total_disc_pct").alias("total_pct_sum"), F.count("total_disc_pct").alias("total_pct_n"))


def tables_from(base: DataFrame, tops: dict[str, list], spark, start, end) -> dict[str, DataFrame]:
    """The ten tables, as ``operators.rollups`` defines them, from the base aggregate."""
    def part(name: str) -> DataFrame:
        own = base.filter(F.col("gid") == _gid(SETS[name], KEYS))
        return own if name == "daily_trend" else own.filter("in_window")

    pct = X.ratio_pct("gm_sum", "net_sum").alias("gm_pct")
    asp = (F.col("offer_sum") / F.col("bookings")).alias("asp")
    sums = ["bookings", "gm_sum", F.col("net_sum").alias("revenue_sum")]
    shared = {"booking_weekly": ["week_start", "package_bucket", "city_bucket"], "stacking_weekly": ["week_start", "n_disc_types"]}
    out = {name: part(name).select(*keys, *sums, pct) for name, keys in shared.items()}
    out["coupon_weekly"] = part("coupon_weekly").select(
        "week_start", "coupon_bucket", *sums, "repeat_bookings",
        (F.col("coupon_pct_sum") / F.col("coupon_pct_n")).alias("avg_discount_pct"), pct,
        X.ratio_pct("repeat_bookings", "bookings").alias("repeat_share"))
    out["segment_weekly"] = part("segment_weekly").select(
        "week_start", "customer_category", "booking_flag", "city_bucket", *sums, pct, asp)
    out["channel_weekly"] = part("channel_weekly").select(
        "week_start", "booked_by", "city_bucket", *sums,
        (F.col("total_pct_sum") / F.col("total_pct_n")).alias("avg_discount_pct"), pct)
    out["geo_weekly"] = part("geo_weekly").select(
        "week_start", F.col("city20").alias("city"), F.col("zone30").alias("zone"), *sums, pct, asp)
    out["daily_trend"] = part("daily_trend").select(
        "booking_date", "package_bucket", "city_bucket", *sums, pct,
        (~F.col("booking_date").between(F.lit(start), F.lit(end))).alias("is_partial"))
    out["weekly_waterfall"] = part("weekly_waterfall").select("week_start", "is_partial", "bookings", *_SUMS, pct)
    kept = F.when(F.col("bookings") >= P.MIN_PACKAGE_ROWS, F.col("package_code"))
    packages = part("package_gm").groupBy(F.coalesce(kept, F.lit(P.OTHER)).alias("package_code")).agg(
        *[F.sum(c).alias(c) for c in ("bookings", "gm_sum", "net_sum", "offer_sum")])
    out["package_gm"] = packages.select("package_code", *sums, pct, asp).withColumn("is_combo", X.is_combo())
    info = spark.createDataFrame(tops["package_code"], "package_code string, bookings long")
    out["package_info"] = info.withColumn("note", F.when(X.is_combo(), F.lit("combo booking")).otherwise(F.lit("")))
    return out


# -- checks and publishing -------------------------------------------------------------------

def observed_rows(rows: DataFrame, start, end) -> tuple[DataFrame, Observation]:
    """``rows`` (settled and not) and what a pass over them counts."""
    inside = F.col("booking_date").between(F.lit(start), F.lit(end))
    after = F.col("booking_date") >= F.lit(start)
    settled = F.col("gm_c").isNotNull()
    kinds = [F.coalesce(F.col(c), F.lit(0)) for c in P.DISCOUNT_KINDS]
    gap = (F.col("offer_c") - sum(kinds[1:], kinds[0]) != F.col("net_c")) | (F.col("net_c") - F.col("cpt_c") != F.col("gm_c"))
    seen = Observation(f"fact-{uuid.uuid4().hex}")
    metrics = [X.count_when(inside & settled).alias("rows_window"), X.count_when(after & settled).alias("rows_after"),
               X.count_when(inside & ~settled).alias("unsettled"), X.count_when(inside & settled & gap).alias("broken_rows"),
               X.sum0(F.when(inside, F.col("gm_c"))).alias("gm_window"), X.sum0(F.when(after, F.col("gm_c"))).alias("gm_after"),
               X.sum0(F.when(inside & settled, F.col("net_c"))).alias("net_window"),
               X.sum0(F.when(after & settled, F.col("net_c"))).alias("net_after")]
    return rows.observe(seen, *metrics), seen


def disagreements(fact: dict, written: dict[str, dict]) -> list[str]:
    """What the tables' own counts and the scan's counts do not agree on."""
    found = []
    if fact["broken_rows"]:
        found.append(f"{fact['broken_rows']} rows whose offer, discounts, net, cost and margin do not add up")
    for name, got in written.items():
        if name == "package_info":
            continue
        side = "after" if name == "daily_trend" else "window"
        for what, want in (("bookings", fact[f"rows_{side}"]), ("gm", fact[f"gm_{side}"]), ("net", fact[f"net_{side}"])):
            if got[what] != want:
                found.append(f"{name} has {what} {got[what]}, the fact {want}")
    return found


def written_tables(tables: dict[str, DataFrame], folder: str, fmt: str) -> dict[str, dict]:
    """Write every table under ``folder``; per table its total bookings, margin and revenue, as
    counted by its own write."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        net = "net_sum" if "net_sum" in df.columns else "revenue_sum"
        totals = [X.sum0("bookings").alias("bookings")]
        totals += [X.sum0(c).alias(a) for c, a in (("gm_sum", "gm"), (net, "net")) if c in df.columns]
        w = df.observe(seen, *totals).write.format(fmt)
        (w.option("header", True) if fmt == "csv" else w).save(f"{folder}/{name}")
        counts[name] = seen.get
    return counts


def refresh(ctx: Context, out_dir: str, fmt: str = "parquet", corrupt=None) -> dict[str, str]:
    """Two scans of the fact, ten tables. They are written beside ``out_dir``'s tables and take
    their place only when every count agrees, else AssertionError and nothing changes. ``corrupt``
    (for tests) changes the tables before they are written."""
    spark, (start, end) = ctx.spark, ctx.window
    out_dir = out_dir.rstrip("/")
    staging = f"{out_dir}/_staging-{uuid.uuid4().hex}"
    fs, path = folder_of(spark, out_dir)
    try:
        tops = learned_tops(ctx.clean)
        rows, seen = observed_rows(ctx.bookings, start, end)
        rows = PR.settled_rows(rows).filter(F.col("booking_date") >= F.lit(start))
        base_aggregate(rows, tops, start, end).write.parquet(f"{staging}/base")
        tables = tables_from(spark.read.parquet(f"{staging}/base"), tops, spark, start, end)
        counts = written_tables(corrupt(tables) if corrupt else tables, f"{staging}/tables", fmt)
        if broken := disagreements(seen.get, counts):
            raise AssertionError("; ".join(broken))
        for name in tables:
            target = path(f"{out_dir}/{name}")
            fs.delete(target, True)
            if not fs.rename(path(f"{staging}/tables/{name}"), target):
                raise RuntimeError(f"{name} could not be put in place")
    finally:
        fs.delete(path(staging), True)
    return {name: f"{out_dir}/{name}" for name in tables}
