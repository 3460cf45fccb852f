"""Week-bin interval joins against the plain range condition, with many events and no broadcast."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import intervals as I
from ledgerlens.operators import pricing as M
from ledgerlens.plans.context import context
from ledgerlens.sources import dims as D


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def events(spark, panel, n):
    """n events over the panel's skus and markets, on any day of the week, some not executed."""
    cells = panel.select("sku", "market").distinct().collect()
    cells.sort()
    rng = random.Random(6)
    markets = sorted({c.market for c in cells})
    rows = []
    for k in range(n):
        c = rng.choice(cells)
        day = dt.date(1996, 1, 1) + dt.timedelta(days=rng.randrange(1800))
        rows.append((f"E{k}", c.sku, c.market, rng.choice([-10, 5, 12]), None if k % 50 == 0 else day, "executed",
                     rng.choice(markets)))
    return spark.createDataFrame(rows, "event_id string, sku string, market string, pct_change int, change_week date, "
                                       "status string, control_market string")


def test_a_hundred_thousand_events_without_broadcast(spark, sf_small, no_broadcast):
    ctx = context(spark, sf_small)
    ev = events(spark, ctx.panel, 100_000).cache()
    got = M.event_window_range(ctx.clean, ev, cells=ctx.daily_cells)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    x = ev.where("change_week is not null").alias("e").join(ctx.daily_cells.alias("c"), F.expr(
        "e.sku = c.sku and e.market = c.market and booking_date between date_sub(change_week, 28) and date_add(change_week, 27)"))
    total = [F.count(F.lit(1)), F.sum("bookings"), F.sum("gm_sum"), F.sum(F.xxhash64("event_id", "booking_date") % 1000003)]
    assert got.agg(*total).first() == x.agg(*total).first() and got.count() > 100_000
    arms = M._arm_totals(ctx.panel, ev, 6)
    y = ev.where("change_week is not null").alias("e").join(ctx.panel.alias("p"), F.expr(
        "e.sku = p.sku and e.market = p.market and week_start between date_sub(change_week, 42) and date_add(change_week, 35)"))
    sums = [F.sum(F.col("t_pre") + F.col("t_post"))]
    assert arms.agg(*sums).first()[0] == y.agg(F.sum("bookings")).first()[0]
    ev.unpersist()


def test_flags_equal_the_plain_condition(spark, sf_small, no_broadcast):
    ev = events(spark, context(spark, sf_small).panel, 3000).cache()
    promos = D.promo_events(spark)
    got = {(r.event_id, r.market): r.promos_in_post for r in M.confounder_overlap(ev, promos).collect()}
    pushes = [(r.market, r.week_start) for r in promos.where("scope = 'market'").collect()]
    rows = [r for r in ev.collect() if r.change_week]
    within = lambda d, lo, hi: lo <= d <= hi
    day = dt.timedelta(days=1)
    assert got == {(r.event_id, r.market): sum(m == r.market and within(w, r.change_week, r.change_week + 35 * day)
                                               for m, w in pushes) for r in rows}
    by_cell = {}
    for r in rows:
        by_cell.setdefault((r.sku, r.market), []).append(r.change_week)
    seen = {r.event_id: r.control_events for r in M.control_contamination(ev, promos).collect()}
    assert seen == {r.event_id: sum(within(w, r.change_week - 42 * day, r.change_week + 35 * day)
                                    for w in by_cell.get((r.sku, r.control_market), [])) for r in rows}
    ev.unpersist()


def test_running_multiplier_equals_the_product(spark, sf_small, no_broadcast):
    panel = context(spark, sf_small).panel
    ev = events(spark, panel, 400).withColumn("e", F.when(F.col("event_id") != "E7", F.lit(-1.3)))
    got = M.elastic_multiplier(panel, ev, "e").collect()
    rows = [r for r in ev.collect() if r.change_week]
    assert len(got) == panel.count()
    for r in got[::37]:
        active = [x for x in rows if (x.sku, x.market) == (r.sku, r.market) and x.change_week <= r.week_start]
        price = volume = 1.0
        for x in active:
            price *= 1 + x.pct_change / 100
            volume *= (1 + x.pct_change / 100) ** -1.3
        assert r.events_active == len(active) and r.price_mult == pytest.approx(price)
        if any(x.event_id == "E7" for x in active):
            assert r.volume_mult is None
        else:
            assert r.volume_mult == pytest.approx(volume)


def test_window_edges(spark):
    w = spark.createDataFrame([("a", dt.date(2020, 1, 1), dt.date(2020, 1, 20)), ("b", dt.date(2020, 1, 6), dt.date(2020, 1, 6)),
                               ("c", None, dt.date(2020, 1, 6)), ("d", dt.date(2020, 2, 1), dt.date(2020, 1, 1))],
                              "k string, lo date, hi date")
    days = spark.createDataFrame([(dt.date(2019, 12, 30) + dt.timedelta(days=k),) for k in range(40)], "day date")
    j = I.in_windows(I.by_week(w, F.col("lo"), F.col("hi")), days, {}, "day", "left")
    got = {r.k: (r.n, r.first) for r in j.groupBy("k").agg(F.count("day").alias("n"), F.min("day").alias("first")).collect()}
    assert got == {"a": (20, dt.date(2020, 1, 1)), "b": (1, dt.date(2020, 1, 6)), "c": (0, None), "d": (0, None)}
