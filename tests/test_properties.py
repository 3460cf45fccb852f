"""Property tests: each example is a whole frame, checked in one Spark job against a
brute-force computation in plain Python."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.operators import prepare as PR
from ledgerlens.operators import pricing as M

KINDS = ("special_c", "vip_c", "coupon_c", "redcash_c", "giftcard_c")
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

MON = dt.date(1996, 1, 1)
event = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["X", "Y"]), st.integers(0, 9),
                  st.integers(-20, 20), st.one_of(st.none(), st.floats(-3, 0, allow_nan=False)))
cell = st.tuples(st.integers(0, 12), st.sampled_from(["X", "Y"]), st.sampled_from(["A", "B"]))


@SETTINGS
@given(events=st.lists(event, max_size=6), cells=st.lists(cell, min_size=1, max_size=20, unique=True))
def test_elastic_multiplier_matches_brute_force(spark, events, cells):
    """price = prod(1+p) and volume = prod((1+p)^e) over active executed events; an active
    event with unknown elasticity makes the volume multiplier unknown."""
    ev_rows = [(f"E{i}", sku, mkt, pct, MON + dt.timedelta(weeks=w), e)
               for i, (sku, mkt, w, pct, e) in enumerate(events)]
    ev = spark.createDataFrame(ev_rows, "event_id string, sku string, market string, pct_change int, "
                                        "change_week date, el double")
    cl = spark.createDataFrame([(MON + dt.timedelta(weeks=w), m, s) for w, m, s in cells],
                               "week_start date, market string, sku string")
    got = {(r["week_start"], r["market"], r["sku"]): r for r in M.elastic_multiplier(cl, ev, "el").collect()}
    assert len(got) == len(cells)
    for w, m, s in cells:
        wk = MON + dt.timedelta(weeks=w)
        active = [(pct, e) for _, sku, mkt, pct, cw, e in ev_rows if sku == s and mkt == m and cw <= wk]
        r = got[(wk, m, s)]
        assert r["events_active"] == len(active)
        assert r["price_mult"] == pytest.approx(math.prod(1 + p / 100 for p, _ in active), rel=1e-12)
        if any(e is None for _, e in active):
            assert r["volume_mult"] is None
        else:
            assert r["volume_mult"] == pytest.approx(math.prod((1 + p / 100) ** e for p, e in active), rel=1e-9)
