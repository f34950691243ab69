"""Present the driver's star-schema tables in the Bronze order-items layout.

The order data this library is built for (order lines, options, calendar)
is derived here, by fixed rules, from ``lineitem``, ``orders``, ``customer``
and ``part``; the same rules are written in SQL in ``plans.oracle`` so both
engines see the same Bronze rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MONEY
from .bronze import Bronze

# Fixed values of the derivation rules.
LOYALTY_SEGMENTS = ("BUILDING", "HOUSEHOLD")   # customers in these segments hold a loyalty card
GUEST_EVERY = 50                                # every 50th customer orders as a guest (null user_id)
RESTAURANTS = 20                                # restaurant_id = 'R' || suppkey % 20
ALWAYS_FREE_PREFIX = "small"                    # parts named 'small …' are always free
CURRENCY = "USD"
# Calendar holidays: (MM-dd, name).
HOLIDAYS = (("01-01", "New Year's Day"), ("07-04", "Independence Day"), ("12-25", "Christmas Day"))

# Tie-breakers carried only for deduplication; dropped by the cleaning step.
TIEBREAK_COLUMNS = ("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
DEDUP_ORDER = ("l_partkey", "l_suppkey", "item_quantity", "l_extendedprice", "l_shipdate")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    p = read_table(spark, sf_dir, "part")
    loyal = F.col("c_mktsegment").isin(*LOYALTY_SEGMENTS)
    free = F.col("p_name").startswith(ALWAYS_FREE_PREFIX) | F.col("_undiscounted")
    # Parts join the lines while they are narrow and customers join the orders, not the lines. Lines and orders meet last, on
    # the order's text id: the rows then lie by order_id, so that grouping by it and by more columns shuffles nothing again.
    orders = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").cast("string").alias("order_id"), "o_custkey", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment")
    li = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("_quantity"),
                   (F.col("l_discount") == 0).alias("_undiscounted"), *TIEBREAK_COLUMNS)
    lines = li.join(p, li.l_partkey == p.p_partkey).withColumn("order_id", F.col("l_orderkey").cast("string"))
    return (lines.join(orders, "order_id")
            .select(
                F.col("o_orderpriority").alias("app_name"),
                F.concat(F.lit("R"), (F.col("l_suppkey") % RESTAURANTS).cast("string")).alias("restaurant_id"),
                F.col("o_orderdate").cast(T.TimestampType()).alias("creation_time_utc"),
                "order_id",
                F.when(F.col("o_custkey") % GUEST_EVERY != 0, F.col("o_custkey").cast("string")).alias("user_id"),
                F.when(loyal, F.col("c_name")).alias("printed_card_number"),
                loyal.alias("is_loyalty"),
                F.lit(CURRENCY).alias("currency"),
                F.col("l_linenumber").cast("string").alias("lineitem_id"),
                F.col("p_type").alias("item_category"),
                F.col("p_name").alias("item_name"),
                F.when(free, F.lit(0.0)).otherwise(F.col("p_retailprice")).cast(MONEY).alias("item_price"),
                F.col("_quantity").alias("item_quantity"),
                *[F.col(c) for c in TIEBREAK_COLUMNS],
            ))


# Which lines of the raw layout are defective.
NULL_ORDER_EVERY, NULL_TIME_EVERY, BAD_PRICE_EVERY, BAD_QUANTITY_EVERY = 499, 97, 101, 89


def null_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines where every 499th order has lost its id."""
    items = order_items(spark, sf_dir)
    return items.withColumn("order_id", F.when(F.col("order_id").cast("long") % NULL_ORDER_EVERY != 0, F.col("order_id")))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as they may arrive: some without order id or time, with negative prices or no quantity."""
    order = F.col("order_id").cast("long")
    return (order_items(spark, sf_dir)
            .withColumn("creation_time_utc", F.when(order % NULL_TIME_EVERY != 0, F.col("creation_time_utc")))
            .withColumn("item_price", F.when(F.col("l_partkey") % BAD_PRICE_EVERY == 0, -F.col("item_price") - 1)
                        .otherwise(F.col("item_price")).cast(MONEY))
            .withColumn("item_quantity", F.when(F.col("l_suppkey") % BAD_QUANTITY_EVERY == 0, 0).otherwise(F.col("item_quantity")))
            .withColumn("order_id", F.when(order % NULL_ORDER_EVERY != 0, F.col("order_id"))))


# Most customers' orders lie within REGULAR_DAYS; of every third customer's, each NEW_ORDER_EVERY-th lies within NEW_DAYS.
REGULAR_DAYS, NEW_CUSTOMER_EVERY, NEW_ORDER_EVERY, NEW_DAYS = 180, 3, 10, 30


def newcomer_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines with moved dates: most customers order often of late, every third one hardly ever."""
    items = order_items(spark, sf_dir)
    last = items.agg(F.max("creation_time_utc")).first()[0]
    if last is None:
        return items
    user, age = F.col("user_id").cast("long"), F.datediff(F.lit(last), F.col("creation_time_utc"))
    moved = lambda days: F.date_sub(F.lit(last).cast("date"), age % days).cast(T.TimestampType())
    rare = F.col("order_id").cast("long") % NEW_ORDER_EVERY == 0
    return items.withColumn("creation_time_utc", F.when(user % NEW_CUSTOMER_EVERY != 0, moved(REGULAR_DAYS))
                            .when((user % NEW_CUSTOMER_EVERY == 0) & rare, moved(NEW_DAYS)).otherwise(F.col("creation_time_utc")))


def item_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed on order lines: every line row is an update at its ship date,
    and a returned line (flag ``R``) is a delete. ``seq`` orders the feed after
    the full load (``seq`` 0) at equal timestamps."""
    li = read_table(spark, sf_dir, "lineitem")
    p = read_table(spark, sf_dir, "part")
    free = F.col("p_name").startswith(ALWAYS_FREE_PREFIX) | (F.col("l_discount") == 0)
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("l_orderkey").cast("string").alias("order_id"),
                    F.col("l_linenumber").cast("string").alias("lineitem_id"),
                    F.col("p_name").alias("item_name"),
                    F.when(free, F.lit(0.0)).otherwise(F.col("p_retailprice")).cast(MONEY).alias("item_price"),
                    F.col("l_quantity").cast("int").alias("item_quantity"),
                    F.col("l_shipdate").cast(T.TimestampType()).alias("commit_ts"),
                    F.lit(1).alias("seq"),
                    F.when(F.col("l_returnflag") == "R", F.lit("D")).otherwise(F.lit("U")).alias("op"),
                    "l_partkey", "l_suppkey", "l_extendedprice"))


CHANGE_ORDER = ("commit_ts", "seq", "l_partkey", "l_suppkey", "l_extendedprice")


def order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    k = F.explode(F.filter(F.array(F.lit(1), F.lit(2)),
                           lambda x: x <= F.col("l_quantity").cast("int") % 3)).alias("k")
    return (li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax", k)
            .select(
                F.col("l_orderkey").cast("string").alias("order_id"),
                F.col("l_linenumber").cast("string").alias("lineitem_id"),
                F.col("l_returnflag").alias("option_group_name"),
                F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("k").cast("string")).alias("option_name"),
                F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.round(F.col("l_tax") * 100, 2))
                .cast(MONEY).alias("option_price"),
                F.col("k").cast("int").alias("option_quantity"),
            ))


def comped_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options where the second one of group ``A`` is always free."""
    comped = (F.col("option_group_name") == "A") & (F.col("option_quantity") == 2)
    return order_item_options(spark, sf_dir).withColumn(
        "option_price", F.when(comped, 0).otherwise(F.col("option_price")).cast(MONEY))


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and last order date, as raw text keys."""
    o = read_table(spark, sf_dir, "orders")
    bounds = o.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("d"))   # one row per calendar day
    md = F.date_format("d", "MM-dd")
    name = F.lit(None).cast("string")
    for key, label in reversed(HOLIDAYS):
        name = F.when(md == key, F.lit(label)).otherwise(name)
    return days.select(
        F.date_format("d", "dd-MM-yyyy").alias("date_key"),
        F.date_format("d", "EEEE").alias("day_of_week"),
        F.weekofyear("d").alias("week"),
        F.date_format("d", "MMMM").alias("month"),
        F.year("d").alias("year"),
        F.dayofweek("d").isin(1, 7).alias("is_weekend"),
        name.isNotNull().alias("is_holiday"),
        name.alias("holiday_name"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(order_items(spark, sf_dir), order_item_options(spark, sf_dir), date_dim(spark, sf_dir),
                  dedup_order=DEDUP_ORDER, drop_after_dedup=TIEBREAK_COLUMNS)
