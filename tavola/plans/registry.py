"""Named queries over the driver's tables, each paired with its oracle SQL.

Every query derives Bronze from the star-schema tables under ``sf_dir``,
runs the library's plan and returns a frame whose values compare exactly
with the SQL: money as the double of an exact decimal, counts and scores
as BIGINT, means as exact sum over count in double.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import star
from . import clean as C
from . import metrics as M
from .oracle_sql import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def comparable(df: DataFrame, round6: tuple[str, ...] = ()) -> DataFrame:
    """Decimals → double, small integers → bigint; ``round6`` columns rounded to 6 places
    (means of doubles, whose last bits depend on summation order)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast(T.DoubleType())
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast(T.LongType())
        if f.name in round6:
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --- shared building blocks (one plan per call; no state across sessions) ---

def bronze(spark: SparkSession, sf_dir: str) -> star.Bronze:
    return star.bronze(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return C.clean(bronze(spark, sf_dir))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)[0]


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    s = sales(spark, sf_dir)
    if name == "customer_intelligence":
        return M.customer_intelligence(s)
    if name == "customer_rolling_metrics":
        return M.customer_rolling_metrics(M.order_timeline(M.checkpointed(M.order_summary(s))))
    if name == "location_sales_trends":
        return M.location_sales_trends(s)
    if name == "loyalty_roi_analysis":
        return M.loyalty_roi_analysis(M.order_summary(s))
    if name == "discount_effectiveness":
        return M.discount_effectiveness(s)
    raise KeyError(name)


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {c}"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT) AS {c}"


def r6(c: str) -> str:
    return f"round({c}, 6) AS {c}"


SALES_COLS = ("order_id, lineitem_id, app_name, restaurant_id, creation_time_utc, user_id, printed_card_number, "
              "is_loyalty, currency, item_category, item_name, " + dbl("item_price") + ", "
              + big("item_quantity") + ", order_date, " + dbl("item_total") + ", option_group_name, option_name, "
              + dbl("option_price") + ", " + big("option_quantity") + ", " + dbl("option_total") + ", "
              + dbl("total_line_item_revenue"))

INTEL_COLS = ("user_id, last_purchase_date, " + dbl("current_clv") + ", " + big("frequency") + ", "
              + dbl("monetary_value") + ", avg_gap_between_orders, " + r6("avg_spend_change_pct") + ", "
              + big("recency") + ", " + ", ".join(big(c) for c in ("r_score", "f_score", "m_score", "clv_score"))
              + ", clv_tier, churn_status, segment")


# --- Bronze → Silver -------------------------------------------------------

@register("dedup_order_items", with_ctes(
    "SELECT app_name, restaurant_id, creation_time_utc, order_id, user_id, printed_card_number, is_loyalty, "
    "currency, lineitem_id, item_category, item_name, " + dbl("item_price") + ", " + big("item_quantity")
    + " FROM items"))
def q_dedup_order_items(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return comparable(C.dedup_order_items(b.order_items, b.dedup_order).drop(*b.drop_after_dedup))


@register("guest_fill", with_ctes(
    "SELECT user_id, CAST(count(*) AS BIGINT) AS line_count FROM c_items GROUP BY user_id"))
def q_guest_fill(spark, sf_dir):
    b = bronze(spark, sf_dir)
    items = C.clean_order_items(b.order_items, b.dedup_order, b.drop_after_dedup)
    return items.groupBy("user_id").agg(F.count(F.lit(1)).alias("line_count"))


@register("silver_sales_fact", with_ctes(f"SELECT {SALES_COLS} FROM sales"))
def q_silver_sales_fact(spark, sf_dir):
    return comparable(sales(spark, sf_dir))


@register("sales_fact_dedup_options", with_ctes(
    "SELECT order_id, lineitem_id, option_name, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue, "
    "CAST(count(*) AS BIGINT) AS lines FROM (SELECT i.order_id, i.lineitem_id, o.option_name, "
    "i.item_total + coalesce(o.option_total, 0) AS total_line_item_revenue FROM c_items i LEFT JOIN "
    "(SELECT *, option_price * option_quantity AS option_total FROM (SELECT DISTINCT * FROM f_opts)) o "
    "ON i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id) GROUP BY order_id, lineitem_id, option_name"))
def q_sales_fact_dedup_options(spark, sf_dir):
    s = C.clean(bronze(spark, sf_dir), dedup_options=True)[0]
    return comparable(s.groupBy("order_id", "lineitem_id", "option_name").agg(
        F.sum("total_line_item_revenue").alias("revenue"), F.count(F.lit(1)).alias("lines")))


@register("date_dim_parse", with_ctes(
    "SELECT date_key, day_of_week, " + big("week") + ", month, " + big("year")
    + ", is_weekend, is_holiday, holiday_name FROM dates"))
def q_date_dim_parse(spark, sf_dir):
    return comparable(silver(spark, sf_dir)[1])


# --- Silver → Gold ---------------------------------------------------------

@register("order_summary", with_ctes(
    "SELECT user_id, order_id, order_date, " + dbl("order_revenue") + ", is_loyalty FROM order_summary"))
def q_order_summary(spark, sf_dir):
    return comparable(M.order_summary(sales(spark, sf_dir)))


@register("order_summary_exact", with_ctes(
    "SELECT user_id, order_id, order_date, CAST(sum(item_total + option_total) AS DOUBLE) AS order_revenue, "
    "bool_or(is_loyalty) AS is_loyalty FROM ("
    " SELECT user_id, order_id, order_date, lineitem_id, max(item_total) AS item_total,"
    " sum(option_total) AS option_total, bool_or(is_loyalty) AS is_loyalty"
    " FROM sales WHERE user_id <> 'GUEST' GROUP BY user_id, order_id, order_date, lineitem_id)"
    " GROUP BY user_id, order_id, order_date"))
def q_order_summary_exact(spark, sf_dir):
    return comparable(M.order_summary_exact(sales(spark, sf_dir)))


@register("order_metrics", with_ctes(
    "SELECT user_id, order_id, order_date, " + dbl("order_revenue") + ", is_loyalty, prev_order_date, "
    + dbl("prev_order_revenue") + ", " + big("days_since_prev_order") + ", spend_change_pct FROM order_metrics"))
def q_order_metrics(spark, sf_dir):
    return comparable(M.order_metrics(M.order_timeline(M.checkpointed(M.order_summary(sales(spark, sf_dir))))))


@register("customer_base", with_ctes(
    "SELECT user_id, last_purchase_date, " + dbl("current_clv") + ", " + big("frequency") + ", "
    + dbl("monetary_value") + ", avg_gap_between_orders, " + r6("avg_spend_change_pct") + ", "
    + big("recency") + " FROM customer_base"))
def q_customer_base(spark, sf_dir):
    rollup = M.checkpointed(M.order_rollup(sales(spark, sf_dir)))
    base = M.customer_base(M.order_timeline(M.registered(rollup)), M.reference_date(rollup))
    return comparable(base, round6=("avg_spend_change_pct",))


@register("rfm_scores", with_ctes(
    "SELECT user_id, " + big("recency") + ", " + big("frequency") + ", " + dbl("monetary_value") + ", "
    + dbl("current_clv") + ", " + ", ".join(big(c) for c in ("r_score", "f_score", "m_score", "clv_score"))
    + " FROM scored"))
def q_rfm_scores(spark, sf_dir):
    df = gold(spark, sf_dir, "customer_intelligence")
    return comparable(df.select("user_id", "recency", "frequency", "monetary_value", "current_clv",
                                "r_score", "f_score", "m_score", "clv_score"))


@register("clv_tiers", with_ctes(
    "SELECT clv_tier, CAST(count(*) AS BIGINT) AS customers, CAST(sum(current_clv) AS DOUBLE) AS total_clv, "
    "CAST(min(current_clv) AS DOUBLE) AS min_clv, CAST(max(current_clv) AS DOUBLE) AS max_clv "
    "FROM intel GROUP BY clv_tier"))
def q_clv_tiers(spark, sf_dir):
    df = gold(spark, sf_dir, "customer_intelligence")
    return comparable(df.groupBy("clv_tier").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("current_clv").alias("total_clv"),
        F.min("current_clv").alias("min_clv"), F.max("current_clv").alias("max_clv")))


@register("customer_intelligence", with_ctes(f"SELECT {INTEL_COLS} FROM intel"))
def q_customer_intelligence(spark, sf_dir):
    return comparable(gold(spark, sf_dir, "customer_intelligence"), round6=("avg_spend_change_pct",))


@register("customer_rolling_metrics", with_ctes(
    "SELECT user_id, order_id, order_date, " + dbl("order_revenue") + ", is_loyalty, " + dbl("running_clv")
    + " FROM order_metrics"))
def q_customer_rolling_metrics(spark, sf_dir):
    return comparable(gold(spark, sf_dir, "customer_rolling_metrics"))


@register("location_sales_trends", with_ctes(
    "SELECT order_date, restaurant_id, item_category, " + dbl("daily_revenue") + ", "
    + big("daily_order_count") + " FROM trends"))
def q_location_sales_trends(spark, sf_dir):
    return comparable(gold(spark, sf_dir, "location_sales_trends"))


@register("loyalty_roi_analysis", with_ctes(
    "SELECT is_loyalty, " + big("total_customers") + ", avg_order_value, repeat_order_rate, "
    + dbl("total_lifetime_value") + " FROM loyalty"))
def q_loyalty_roi_analysis(spark, sf_dir):
    return comparable(gold(spark, sf_dir, "loyalty_roi_analysis"))


@register("max_price_ever", with_ctes(
    "SELECT 'item' AS kind, item_name AS name, CAST(max(item_price) AS DOUBLE) AS max_price_ever "
    "FROM sales GROUP BY item_name UNION ALL "
    "SELECT 'option' AS kind, option_name AS name, CAST(max(option_price) AS DOUBLE) AS max_price_ever "
    "FROM sales GROUP BY option_name"))
def q_max_price_ever(spark, sf_dir):
    items, options = M.max_price_ever(sales(spark, sf_dir))
    return comparable(
        items.select(F.lit("item").alias("kind"), F.col("item_name").alias("name"),
                     F.col("max_item_price_ever").alias("max_price_ever"))
        .unionByName(options.select(F.lit("option").alias("kind"), F.col("option_name").alias("name"),
                                    F.col("max_option_price_ever").alias("max_price_ever"))))


@register("discount_flags", with_ctes(
    "SELECT order_id, lineitem_id, item_name, option_name, " + dbl("item_price") + ", " + dbl("option_price")
    + ", " + dbl("max_item_price_ever") + ", " + dbl("max_option_price_ever") + ", "
    + big("is_true_discount") + " FROM flags"))
def q_discount_flags(spark, sf_dir):
    columns = ("order_id", "lineitem_id", "item_name", "option_name", "item_price", "option_price")
    lines = M.checkpointed(sales(spark, sf_dir).select(*columns))   # flags and maxima read the written lines
    return comparable(M.discount_flags(lines).select(*columns, "max_item_price_ever", "max_option_price_ever",
                                                     "is_true_discount"))


@register("discount_effectiveness", with_ctes(
    "SELECT " + big("is_discounted") + ", " + big("order_count") + ", " + dbl("total_revenue")
    + ", avg_order_value FROM discount"))
def q_discount_effectiveness(spark, sf_dir):
    return comparable(gold(spark, sf_dir, "discount_effectiveness"))


@register("discount_effectiveness_exact", with_ctes(
    "SELECT " + big("is_discounted") + ", " + big("order_count") + ", " + dbl("total_revenue")
    + ", CAST(total_revenue AS DOUBLE) / nullif(order_count, 0) AS avg_order_value FROM discount"))
def q_discount_effectiveness_exact(spark, sf_dir):
    return comparable(M.discount_effectiveness_exact(sales(spark, sf_dir)))


def _load_reports() -> None:
    # Reports, exploration and table-work queries register themselves on import.
    from . import explore, layout, loads, reports, tablework  # noqa: F401


@lru_cache(maxsize=1)
def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_reports()
    return dict(QUERIES)


@lru_cache(maxsize=1)
def all_oracles() -> dict[str, str]:
    _load_reports()
    return dict(ORACLE)
