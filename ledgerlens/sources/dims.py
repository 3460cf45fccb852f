"""Small dimension tables (coupon rules, price/promo events, price actions, competitors).

They are parameter tables (tens of rows); each builder returns a DataFrame with a declared
schema. Their size is fixed by the parameter list, not by the data; the coupon rules join by
Spark's choice from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P

RULE_SCHEMA = T.StructType([
    T.StructField("coupon_code", T.StringType(), False),
    T.StructField("coupon_name", T.StringType(), True),
    T.StructField("mov_c", T.LongType(), True),
    T.StructField("rule_type", T.StringType(), True),
    T.StructField("discount", T.IntegerType(), True),
    T.StructField("valid_once", T.StringType(), True),
    T.StructField("is_red_cash", T.StringType(), True),
    T.StructField("upper_limit", T.IntegerType(), True),
    T.StructField("created_by", T.StringType(), True),
    T.StructField("user_group", T.StringType(), True),
    T.StructField("create_date", T.DateType(), True),
    T.StructField("active", T.StringType(), True),
])


def _rules_df(spark: SparkSession, rules) -> DataFrame:
    rows = [(r.code, r.name, r.mov_c, r.kind, r.discount, r.valid_once, r.is_red_cash, r.upper_limit,
             r.created_by, r.user_group, r.create_date, r.active) for r in rules]
    return _literal_rows(spark, rows, RULE_SCHEMA)


def _literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A parameter list as literals, so that Spark knows its size before it plans a join. Of rows given
    to ``createDataFrame`` it does not: the other side, the whole fact, is then shuffled by the key."""
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def crm_rules(spark: SparkSession) -> DataFrame:
    return _rules_df(spark, P.crm_rules())


def family_rules(spark: SparkSession) -> DataFrame:
    return _rules_df(spark, P.family_rules())


def rules_union(spark: SparkSession) -> DataFrame:
    """Rules from the rules table plus the hand-defined family add-on rules."""
    return crm_rules(spark).unionByName(family_rules(spark), allowMissingColumns=True)


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail fast if a dimension key repeats (a left join would fan out, C18).

    The check is one aggregate over the dimension (tens of rows)."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"dimension key {key} is not unique: {dup[0][key]!r}")
    return df


PRICE_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("sku", T.StringType(), False),
    T.StructField("markets", T.ArrayType(T.StringType()), False),
    T.StructField("pct_change", T.IntegerType(), False),
    T.StructField("change_week", T.DateType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("control_market", T.StringType(), False),
])


def price_events(spark: SparkSession) -> DataFrame:
    """One row per event; ``markets`` is the list of treated markets."""
    rows = [(e.event_id, e.sku, list(e.markets), int(e.pct), e.change_week, e.status, e.control)
            for e in P.price_events()]
    return spark.createDataFrame(rows, PRICE_EVENT_SCHEMA)


def price_event_markets(spark: SparkSession) -> DataFrame:
    """One row per event x treated market (explode of the market list)."""
    return price_events(spark).select("event_id", "sku", F.explode("markets").alias("market"), "pct_change",
                                      "change_week", "status", "control_market")


def promo_events(spark: SparkSession) -> DataFrame:
    """Promo / confounder events from three shapes (market pushes, festive weeks, one-off
    global events), concatenated by name (U05)."""
    d = T.StructField("week_start", T.DateType())
    pushes = spark.createDataFrame(P.market_pushes(), T.StructType([d, T.StructField("market", T.StringType())]))
    festive = spark.createDataFrame([(w,) for w in P.festive_weeks()], T.StructType([d]))
    one_off = spark.createDataFrame(P.one_off_events(), T.StructType([d, T.StructField("event", T.StringType())]))
    return (pushes.select("week_start", "market", F.lit("Coupon push").alias("event"), F.lit("market").alias("scope"))
            .unionByName(festive.select("week_start", F.lit("ALL").alias("market"),
                                        F.lit("Festive coupon live").alias("event"), F.lit("global").alias("scope")))
            .unionByName(one_off.select("week_start", F.lit("ALL").alias("market"), "event",
                                        F.lit("global").alias("scope"))))


def price_actions(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("package_code", T.StringType()), T.StructField("package_name", T.StringType()),
                           T.StructField("weekly_gm_delta_c", T.LongType()),
                           T.StructField("actual_price_pct_change", T.DoubleType())])
    return spark.createDataFrame(P.price_actions(), schema)


def competitor_prices_wide(spark: SparkSession) -> DataFrame:
    """sku x one multiplier column per competitor (the shape of a competitor sheet)."""
    by_sku: dict = {}
    for sku, comp, mult in P.competitor_multipliers():
        by_sku.setdefault(sku, {})[comp] = mult
    fields = [T.StructField("sku", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in P.COMPETITORS]
    rows = [tuple([s] + [by_sku[s][c] for c in P.COMPETITORS]) for s in sorted(by_sku)]
    return spark.createDataFrame(rows, T.StructType(fields))


def market_multipliers(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("market", T.StringType()), T.StructField("market_mult", T.DoubleType())])
    return spark.createDataFrame(sorted(P.MARKET_PRICE_MULT.items()), schema)


def depth_tiers(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("tier_order", T.IntegerType()), T.StructField("depth_tier", T.StringType())])
    return spark.createDataFrame(list(enumerate(P.DEPTH_TIERS)), schema)
