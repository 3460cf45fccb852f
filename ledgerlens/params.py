"""Parameters and small dimension tables.

Two kinds of values live here:

* fixed values that must equal the semantics being rebuilt (labels, tier cuts,
  thresholds) -- grouped under the "fixed values" comments below;
* fixture dimensions for the driver tables (coupon rules, price and promo events,
  price actions, competitor multipliers). They are generated from short rules so both
  the Spark jobs and the SQL oracle build the same rows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (semantics of the rollups; keep in this order)
# ---------------------------------------------------------------------------
DISCOUNT_KINDS = ["special_c", "vip_c", "coupon_c", "redcash_c", "giftcard_c"]
DEPTH_TIERS = ["0% - no discount", "1-10%", "10-20%", "20-30%", "30-40%", "40%+", "unknown"]
DEPTH_CUTS = [0.10, 0.20, 0.30, 0.40]
STACK_BUCKETS = ["0", "1", "2", "3+"]
OTHER = "OTHER"
NONE_COUPON = "NONE"
FRESH, REPEAT = "Fresh", "Repeat"
CHANNELS = ["Self", "Sales", "Phlebo"]
CATEGORIES = ["regular", "vip", "vip gold"]
RISK_NO_DATA = "No data"
RISK_HIGH = "HIGH -- price cut on already heavily-discounted package"
RISK_LOW_CLEAN = "LOW -- clean, price increase on lightly-discounted package"
RISK_MEDIUM = "MEDIUM -- high coupon exposure, monitor stacking"
RISK_LOW = "LOW"
TOP_N = {"city6": 6, "city15": 15, "package15": 15, "city20": 20, "coupon30": 30, "zone30": 30, "package80": 80,
         "agent20": 20}
MIN_PACKAGE_ROWS = 10            # package kept in package_gm when it has >= 10 rows
MIN_N_FOR_PERCENTAGES = 100      # suppression threshold for shares
UPPER_LIMIT_TOLERANCE = 0.5      # percentage points
BREACH_LIST_SHARE = 0.05         # list coupons breaching on > 5 % of bookings
COMPLIANCE_MIN_BOOKINGS = 10
AGENT_FLOOR = 15
OVER_LIMIT_CEILING = 20          # depth ceiling (percent) for over-limit offers
MOV_ATTENTION_SHARE = 0.10
CAMPAIGN_GM_ATTENTION = 55.0
DID_WINDOW_WEEKS = 6
Z90 = 1.645
FX_RATE = 3.6725                 # indicative currency rate for the currency view
TRAILING_WEEKS = 8
TRAILING_KIND_WEEKS = 6
AOV_OUTLIER_RATIO = 1.25
TOKEN_PATTERN = r"[A-Za-z][A-Za-z0-9_\-]{2,}"   # no upper bound: a long token is never cut into pieces
# Words whose hashed, lower-cased form the token scan looks for (fixture list).
BANNED_WORDS = ["license", "hash", "confidential", "examplecorp", "acme", "internal"]


@dataclass(frozen=True)
class CouponRule:
    code: str
    name: str
    mov_c: int
    kind: str
    discount: int
    valid_once: str
    is_red_cash: str
    upper_limit: int | None
    created_by: str
    user_group: str | None
    create_date: _dt.date | None
    active: str | None


def _monday(d: _dt.date) -> _dt.date:
    return d - _dt.timedelta(days=d.weekday())


def crm_rules() -> list[CouponRule]:
    """Rules for about half the coupon codes the fixture mapping produces.

    Codes are ``CPN{p}_{s}`` with p in 4..40 step 4 and s in 0..5. Suffixes 0-2 have a
    rule; 3 and 4 are unknown to the rules table (J10 finds them); 5 is covered by the
    family add-on rules. MOV is in cents. Suffix 2 rules carry an upper limit below the
    actual depth, so the breach check has positives; suffix 1 has no create date.
    """
    rules = []
    for p in range(4, 41, 4):
        for s in range(3):
            create = None if s == 1 else _monday(_dt.date(1995 + s, 1, 2) + _dt.timedelta(weeks=p))
            rules.append(CouponRule(
                code=f"CPN{p}_{s}", name=f"Coupon {p}% series {s}", mov_c=(s + 1) * 1_500_000,
                kind="percentage", discount=p, valid_once="No" if s else "Yes", is_red_cash="No",
                upper_limit=(p - 4) if s == 2 else p, created_by="CRM", user_group="all",
                create_date=create, active="Yes"))
    return rules


# The four hand-defined family add-on rules (limits 20/25/30/30 percent),
# expressed on this fixture's code space.
FAMILY_RULES = [
    ("CPN20_5", 20),
    ("CPN24_5", 25),
    ("CPN28_5", 30),
    ("CPN32_5", 30),
]


def family_rules() -> list[CouponRule]:
    return [CouponRule(code=c, name=c, mov_c=0, kind="percentage", discount=lim, valid_once="No",
                       is_red_cash="No", upper_limit=lim, created_by="AUTO (family add-on)",
                       user_group=None, create_date=None, active=None)
            for c, lim in FAMILY_RULES]


FAMILY_CODES = [c for c, _ in FAMILY_RULES]


@dataclass(frozen=True)
class PriceEvent:
    event_id: str
    sku: str
    markets: tuple
    pct: float
    change_week: _dt.date | None
    status: str
    control: str


SKUS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
MARKETS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
N_EVENTS, N_EXECUTED = 14, 10


def price_events() -> list[PriceEvent]:
    """Price-change events by one rule over (sku = p_type, market = r_name).

    Event k moves sku 5k mod 6 in market 2k mod 5, every sixth one also in the next market;
    its percent is 3 + (7k mod 13), negative for every fourth; the control is the third market
    after the treated one. Event k < 10 took effect in week 21k after 1995-09-04, the others
    are only planned."""
    first = _monday(_dt.date(1995, 9, 4))
    out = []
    for k in range(N_EVENTS):
        m = 2 * k % 5
        markets = (MARKETS[m], MARKETS[(m + 1) % 5]) if k % 6 == 5 else (MARKETS[m],)
        pct = 3 + 7 * k % 13
        done = k < N_EXECUTED
        out.append(PriceEvent(f"PE{k:02d}", SKUS[5 * k % 6], markets, -pct if k % 4 == 3 else pct,
                              first + _dt.timedelta(weeks=21 * k) if done else None,
                              "live" if done else "planned", MARKETS[(m + 3) % 5]))
    return out


def market_pushes() -> list[tuple]:
    """(week_start, market): every third executed event's market has coupon pushes one and three
    weeks after the change (confounded); event 4's control market has one two weeks before."""
    week = _dt.timedelta(weeks=1)
    done = price_events()[:N_EXECUTED]
    rows = [(e.change_week + n * week, e.markets[0]) for e in done[::3] for n in (1, 3)]
    return rows + [(done[4].change_week - 2 * week, done[4].control)]


def festive_weeks() -> list[_dt.date]:
    """The first Monday of October of every other year."""
    return [_monday(_dt.date(y, 10, 7)) for y in range(1996, 2001, 2)]


def one_off_events() -> list[tuple]:
    return [(_monday(_dt.date(y, 2, 14)), f"Relaunch {y}") for y in (1997, 2000)]


def promo_events() -> list[tuple]:
    """(week_start, market or ALL, event, scope): the three promo shapes concatenated."""
    rows = [(d, m, "Coupon push", "market") for d, m in market_pushes()]
    rows += [(d, "ALL", "Festive coupon live", "global") for d in festive_weeks()]
    rows += [(d, "ALL", e, "global") for d, e in one_off_events()]
    return rows


MARKET_PRICE_MULT = {m: round(1 - 0.015 * k, 3) for k, m in enumerate(MARKETS)}
COMPETITORS = ["comp_a", "comp_b", "comp_c"]


def competitor_multipliers() -> list[tuple]:
    """(sku, competitor, price multiplier vs our list price): a rule over sku index."""
    rows = []
    for i, s in enumerate(SKUS):
        for j, c in enumerate(COMPETITORS):
            rows.append((s, c, round(0.94 + 0.03 * ((i + 2 * j) % 5), 2)))
    return rows


def price_actions() -> list[tuple]:
    """(package_code, package_name, weekly_gm_delta_c, actual_price_pct_change).

    Every tenth package plus two codes the bookings never use (kept, flagged no data)."""
    rows = []
    for p in list(range(0, 200, 10)) + [998, 999]:
        delta = ((p * 37) % 101 - 50) * 1000
        pct = ((p // 10) % 7 - 3) * 2.5
        rows.append((f"PL{p}", f"Package {p}", delta, pct))
    return rows


@dataclass
class WindowParams:
    """Explicit clean window; None means derive it from the file manifest."""
    start: _dt.date | None = None
    end: _dt.date | None = None


@dataclass
class Settings:
    """Typed parameter object; duplicate keys are rejected when parsed (Q04)."""
    values: dict = field(default_factory=dict)

    @staticmethod
    def from_pairs(pairs: list[tuple[str, str]]) -> "Settings":
        seen: dict = {}
        for k, v in pairs:
            key = k.strip()
            if key in seen:
                raise ValueError(f"duplicate settings key: {key}")
            seen[key] = v
        return Settings(seen)
