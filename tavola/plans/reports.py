"""Dashboard reports over the Gold tables (Spark-side; only the small result leaves).

Each function takes Gold DataFrames and returns the table behind one
dashboard view. Registered queries at the bottom pair each with its SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_end, week_ending_sunday
from ..functions.labels import loyalty_label, money, normalise_bool
from ..functions.numeric import as_double, ratio, to_number_or_zero
from ..functions.buckets import equal_width_bin
from . import metrics as M
from .registry import big, comparable, dbl, gold, register, sales, with_ctes

# Fixed values of the dashboard.
NUMERIC_COLUMNS = ("current_clv", "monetary_value", "frequency", "recency", "avg_gap_between_orders",
                   "avg_spend_change_pct")
SEGMENTS = ("VIP", "New Customer", "Churn Risk", "Standard")
TOP_N = 20
HIST_BINS = 20
DEFAULT_LOCATIONS = 3


# --- 1. customer lifetime value ---------------------------------------------

def numeric_coerce(intel: DataFrame) -> DataFrame:
    """The six numeric columns as doubles with unparsable or null values as 0."""
    return intel.select("user_id", *[to_number_or_zero(c).alias(c) for c in NUMERIC_COLUMNS])


def avg_clv_by_tier(intel: DataFrame) -> DataFrame:
    return (intel.groupBy("clv_tier")
            .agg(F.sum("current_clv").alias("_s"), F.count("current_clv").alias("_n"))
            .select("clv_tier", ratio("_s", "_n").alias("avg_clv")))


def top_customers(intel: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` customers by lifetime spend (ties by user_id); planned as TakeOrdered."""
    return (intel.orderBy(F.col("current_clv").desc(), F.col("user_id"))
            .limit(n).select("user_id", "current_clv", "clv_tier"))


def clv_trend_by_tier(rolling: DataFrame, intel: DataFrame, tier: str | None = None) -> DataFrame:
    """Sum of running CLV per day and tier, over customers ordering that day."""
    tiers = intel.select("user_id", "clv_tier")
    if tier is not None:
        tiers = tiers.filter(F.col("clv_tier") == tier)
    return (rolling.join(tiers, "user_id")
            .groupBy("order_date", "clv_tier").agg(F.sum("running_clv").alias("running_clv")))


def clv_cumulative_by_tier(rolling: DataFrame, intel: DataFrame) -> DataFrame:
    """Running total of each tier's daily revenue, all customers counted every day."""
    daily = (rolling.join(intel.select("user_id", "clv_tier"), "user_id")
             .groupBy("clv_tier", "order_date").agg(F.sum("order_revenue").alias("daily_revenue")))
    # One row per (tier, day): bounded by the calendar, not by the number of orders.
    w = Window.partitionBy("clv_tier").orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_clv", F.sum("daily_revenue").over(w))


# --- 2. segmentation ----------------------------------------------------------

def segment_counts(intel: DataFrame) -> DataFrame:
    seg = F.col("segment")
    return intel.agg(F.count(F.lit(1)).alias("total_customers"),
                     *[F.count_if(seg == s).alias(s.lower().replace(" ", "_")) for s in SEGMENTS])


def segment_share(intel: DataFrame) -> DataFrame:
    counts = intel.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    # At most one row per segment: the window over it is tiny.
    total = F.sum("customers").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("share_pct", ratio("customers", total) * F.lit(100.0))


def churn_risk_pct(intel: DataFrame) -> DataFrame:
    return (intel.agg(F.count_if(F.col("segment") == "Churn Risk").alias("churn_risk"),
                      F.count(F.lit(1)).alias("total_customers"))
            .withColumn("churn_risk_pct", ratio("churn_risk", "total_customers") * F.lit(100.0)))


# --- 3. churn indicators -----------------------------------------------------

def high_tier(intel: DataFrame) -> DataFrame:
    return intel.filter(F.col("clv_tier") == "High")


def high_tier_activity(intel: DataFrame) -> DataFrame:
    h = high_tier(intel)
    return h.agg(F.count(F.lit(1)).alias("total_high"),
                 F.count_if(F.col("frequency") > 0).alias("active"),
                 F.count_if(F.col("frequency") == 0).alias("inactive"))


def high_tier_freq_hist(intel: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram of recent order counts among High-tier customers."""
    # One pass over the customers: equal counts collapse first, then their few rows get the bounds.
    h = high_tier(intel).groupBy(F.col("frequency").cast("double").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))
    bounded = h.withColumn("lo", F.min("f").over(every)).withColumn("hi", F.max("f").over(every))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (bounded.withColumn("bin", equal_width_bin(F.col("f"), F.col("lo"), F.col("hi"), bins))
            .withColumn("bin_start", F.col("lo") + (F.col("bin") - 1) * width)
            .groupBy("bin", "bin_start").agg(F.sum("n").alias("customers")))


def winback_list(intel: DataFrame) -> DataFrame:
    """High-tier customers in Churn Risk, most lapsed first."""
    return (high_tier(intel).filter(F.col("segment") == "Churn Risk")
            .select("user_id", "current_clv", "recency", "frequency")
            .orderBy(F.col("recency").desc(), F.col("user_id")))


def has_winback(intel: DataFrame) -> bool:
    """Whether any High-tier customer is in Churn Risk (stops at the first row, no count)."""
    return not winback_list(intel).isEmpty()


def winback_formatted(intel: DataFrame) -> DataFrame:
    return winback_list(intel).withColumn("current_clv", money("current_clv"))


# --- 4. sales trends -----------------------------------------------------------

def coerce_trends(trends: DataFrame) -> DataFrame:
    """Dates as dates and revenue as numbers; unparsable values become null (no zero fill)."""
    from ..functions.numeric import to_number
    return trends.withColumn("order_date", F.to_date("order_date")) \
        .withColumn("daily_revenue", to_number("daily_revenue"))


def location_count(trends: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct locations; ``approx=True`` uses a HyperLogLog sketch (one pass, no shuffle of values)."""
    n = F.approx_count_distinct("restaurant_id", rsd) if approx else F.count_distinct("restaurant_id")
    return trends.agg(n.alias("locations"))


def default_locations(trends: DataFrame, k: int = DEFAULT_LOCATIONS) -> DataFrame:
    """The ``k`` smallest restaurant ids (a top-k of distinct ids)."""
    return trends.select("restaurant_id").distinct().orderBy("restaurant_id").limit(k)


def select_locations(trends: DataFrame, locations: Sequence[str] | DataFrame | None = None) -> DataFrame:
    if locations is None:
        locations = default_locations(trends)
    if isinstance(locations, DataFrame):
        return trends.join(locations.select("restaurant_id"), "restaurant_id", "left_semi")   # broadcast only if measured small
    return trends.filter(F.col("restaurant_id").isin(list(locations)))


def revenue_by_grain(trends: DataFrame, grain: str = "daily", locations=None) -> DataFrame:
    t = select_locations(trends, locations)
    label = {"daily": F.col("order_date"), "weekly": week_ending_sunday("order_date"),
             "monthly": month_end("order_date")}[grain]
    return (t.groupBy(label.alias("order_date"), "restaurant_id")
            .agg(F.sum("daily_revenue").alias("daily_revenue")))


def category_mix(trends: DataFrame, locations=None) -> DataFrame:
    return (select_locations(trends, locations).groupBy("item_category")
            .agg(F.sum("daily_revenue").alias("daily_revenue"))
            .orderBy(F.col("daily_revenue").desc(), "item_category"))


# --- 5. locations ---------------------------------------------------------------

def store_performance(trends: DataFrame) -> DataFrame:
    """Per restaurant: total, mean per (date, category) row, days active, derived AOV, rank."""
    prof = (trends.groupBy("restaurant_id")
            .agg(F.sum("daily_revenue").alias("total_revenue"),
                 F.count("daily_revenue").alias("_nrev"),
                 F.sum("daily_order_count").alias("_orders"),
                 F.count("daily_order_count").alias("_nord"),
                 F.count_distinct("order_date").alias("days_active"))
            .withColumn("avg_daily_revenue", ratio("total_revenue", "_nrev"))
            .withColumn("avg_daily_orders", ratio("_orders", "_nord")))
    return _rank_stores(prof.withColumn(
        "avg_order_value", F.try_divide(as_double("total_revenue"),
                                        F.col("avg_daily_orders") * as_double("days_active")))
        .drop("_nrev", "_orders", "_nord"))


def store_performance_exact(sales_df: DataFrame) -> DataFrame:
    """Per restaurant, rolled up to days first; AOV = revenue / distinct orders."""
    daily = (sales_df.groupBy("restaurant_id", "order_date")
             .agg(F.sum("total_line_item_revenue").alias("rev"), F.count_distinct("order_id").alias("orders")))
    prof = (daily.groupBy("restaurant_id")
            .agg(F.sum("rev").alias("total_revenue"), F.count("rev").alias("_nrev"),
                 F.sum("orders").alias("_orders"), F.count(F.lit(1)).alias("days_active"))
            .withColumn("avg_daily_revenue", ratio("total_revenue", "_nrev"))
            .withColumn("avg_daily_orders", ratio("_orders", "days_active"))
            .withColumn("avg_order_value", ratio("total_revenue", "_orders"))
            .drop("_nrev", "_orders"))
    return _rank_stores(prof)


def _rank_stores(prof: DataFrame) -> DataFrame:
    # One row per restaurant: a small table, ranked in one window.
    w = Window.orderBy(F.col("total_revenue").desc_nulls_last(), F.col("restaurant_id"))
    return prof.withColumn("revenue_rank", F.row_number().over(w))


def store_extremes(perf: DataFrame) -> DataFrame:
    n = F.max("revenue_rank")
    return perf.agg(
        F.max(F.when(F.col("revenue_rank") == 1, F.col("restaurant_id"))).alias("best_restaurant"),
        F.max(F.when(F.col("revenue_rank") == 1, F.col("total_revenue"))).alias("best_revenue"),
        F.max(F.when(F.col("revenue_rank") == 2, F.col("restaurant_id"))).alias("second_restaurant"),
        F.max(F.when(F.col("revenue_rank") == 2, F.col("total_revenue"))).alias("second_revenue"),
        F.max_by("restaurant_id", "revenue_rank").alias("worst_restaurant"),
        F.max_by("total_revenue", "revenue_rank").alias("worst_revenue"),
        n.alias("restaurants"))


def store_gap(perf: DataFrame) -> DataFrame:
    ext = perf.agg(
        F.max(F.when(F.col("revenue_rank") == 1, F.col("total_revenue"))).alias("top_revenue"),
        F.max(F.when(F.col("revenue_rank") == 2, F.col("total_revenue"))).alias("second_revenue"),
        F.sum("total_revenue").alias("_sum"), F.count("total_revenue").alias("_n"))
    return (ext.withColumn("fleet_avg", ratio("_sum", "_n"))
            .withColumn("gap_to_second", F.col("top_revenue") - F.col("second_revenue"))
            .withColumn("pct_above_avg", F.try_divide(as_double("top_revenue") - F.col("fleet_avg"),
                                                      F.col("fleet_avg")) * F.lit(100.0))
            .drop("_sum", "_n"))


def store_leaders(perf: DataFrame) -> DataFrame:
    """Highest-AOV store, highest-volume store and the fleet mean AOV (ties: revenue rank)."""
    return perf.agg(
        F.max_by("restaurant_id", F.struct(F.col("avg_order_value"), -F.col("revenue_rank"))).alias("whale_restaurant"),
        F.max("avg_order_value").alias("whale_aov"),
        F.max_by("restaurant_id", F.struct(F.col("avg_daily_orders"), -F.col("revenue_rank"))).alias("volume_restaurant"),
        F.max("avg_daily_orders").alias("volume_avg_daily_orders"),
        F.avg("avg_order_value").alias("fleet_avg_aov"))


# --- 6. loyalty ------------------------------------------------------------------

def loyalty_labels(loyalty: DataFrame) -> DataFrame:
    return loyalty.withColumn("status", loyalty_label("is_loyalty"))


def loyalty_compare(loyalty: DataFrame) -> DataFrame:
    """Member vs non-member AOV and repeat rate (percent differences) and revenue share."""
    b = normalise_bool("is_loyalty")
    one = loyalty.agg(
        F.max(F.when(b, F.col("avg_order_value"))).alias("member_aov"),
        F.max(F.when(~b, F.col("avg_order_value"))).alias("non_member_aov"),
        F.max(F.when(b, F.col("repeat_order_rate"))).alias("member_repeat_rate"),
        F.max(F.when(~b, F.col("repeat_order_rate"))).alias("non_member_repeat_rate"),
        F.max(F.when(b, F.col("total_lifetime_value"))).alias("_member_ltv"),
        F.sum("total_lifetime_value").alias("_all_ltv"))
    return (one
            .withColumn("aov_diff_pct", F.try_divide(F.col("member_aov") - F.col("non_member_aov"),
                                                     F.col("non_member_aov")) * F.lit(100.0))
            .withColumn("repeat_diff_pct", F.try_divide(F.col("member_repeat_rate") - F.col("non_member_repeat_rate"),
                                                        F.col("non_member_repeat_rate")) * F.lit(100.0))
            .withColumn("loyalty_revenue_share_pct", ratio("_member_ltv", "_all_ltv") * F.lit(100.0))
            .drop("_member_ltv", "_all_ltv"))


def loyalty_ltv(loyalty: DataFrame) -> DataFrame:
    return loyalty_labels(loyalty).select(
        "is_loyalty", "status", "total_customers", "total_lifetime_value",
        ratio("total_lifetime_value", "total_customers").alias("avg_ltv_per_customer"))


# --- 7. discounts -------------------------------------------------------------------

def discount_roi(discount: DataFrame) -> DataFrame:
    """Discounted vs full-price orders: AOV lift and order / revenue shares, from the Gold table."""
    d = F.col("is_discounted") == 1
    one = discount.agg(
        F.max(F.when(d, F.col("order_count"))).alias("discounted_orders"),
        F.max(F.when(~d, F.col("order_count"))).alias("full_price_orders"),
        F.max(F.when(d, F.col("total_revenue"))).alias("discounted_revenue"),
        F.max(F.when(~d, F.col("total_revenue"))).alias("full_price_revenue"),
        F.max(F.when(d, F.col("avg_order_value"))).alias("discounted_aov"),
        F.max(F.when(~d, F.col("avg_order_value"))).alias("full_price_aov"))
    return (one
            .withColumn("aov_lift_pct", F.try_divide(F.col("discounted_aov") - F.col("full_price_aov"),
                                                     F.col("full_price_aov")) * F.lit(100.0))
            .withColumn("discounted_order_share_pct",
                        ratio("discounted_orders", F.col("discounted_orders") + F.col("full_price_orders"))
                        * F.lit(100.0))
            .withColumn("discounted_revenue_share_pct",
                        ratio("discounted_revenue", F.col("discounted_revenue") + F.col("full_price_revenue"))
                        * F.lit(100.0)))


# === registered queries ===============================================================

def _intel(spark, sf_dir):
    return gold(spark, sf_dir, "customer_intelligence")


def _rolling_and_intel(spark, sf_dir):
    rollup = M.checkpointed(M.order_rollup(sales(spark, sf_dir)))   # holds every sales date
    timeline = M.order_timeline(M.registered(rollup))
    return M.customer_rolling_metrics(timeline), M.customer_intelligence(rollup, timeline=timeline)


def _trends(spark, sf_dir):
    return gold(spark, sf_dir, "location_sales_trends")


PCT = "CAST({n} AS DOUBLE) / nullif(CAST({d} AS DOUBLE), 0) * 100"


@register("numeric_coerce", with_ctes(
    "SELECT user_id, " + ", ".join(f"coalesce(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE), 0) AS {c}"
                                   for c in NUMERIC_COLUMNS if c != "avg_spend_change_pct")
    + ", coalesce(round(avg_spend_change_pct, 6), 0) AS avg_spend_change_pct FROM intel"))
def q_numeric_coerce(spark, sf_dir):
    df = numeric_coerce(_intel(spark, sf_dir))
    return df.withColumn("avg_spend_change_pct", F.round("avg_spend_change_pct", 6))


@register("avg_clv_by_tier", with_ctes(
    "SELECT clv_tier, CAST(sum(current_clv) AS DOUBLE) / count(current_clv) AS avg_clv FROM intel GROUP BY clv_tier"))
def q_avg_clv_by_tier(spark, sf_dir):
    return avg_clv_by_tier(_intel(spark, sf_dir))


@register("top_customers", with_ctes(
    "SELECT user_id, " + dbl("current_clv") + ", clv_tier FROM intel ORDER BY current_clv DESC, user_id LIMIT 20"))
def q_top_customers(spark, sf_dir):
    return comparable(top_customers(_intel(spark, sf_dir)))


@register("clv_trend_by_tier", with_ctes(
    "SELECT order_date, clv_tier, CAST(sum(running_clv) AS DOUBLE) AS running_clv "
    "FROM order_metrics JOIN intel USING (user_id) GROUP BY order_date, clv_tier"))
def q_clv_trend_by_tier(spark, sf_dir):
    rolling, intel = _rolling_and_intel(spark, sf_dir)
    return comparable(clv_trend_by_tier(rolling, intel))


@register("clv_trend_high", with_ctes(
    "SELECT order_date, clv_tier, CAST(sum(running_clv) AS DOUBLE) AS running_clv "
    "FROM order_metrics JOIN intel USING (user_id) WHERE clv_tier = 'High' GROUP BY order_date, clv_tier"))
def q_clv_trend_high(spark, sf_dir):
    rolling, intel = _rolling_and_intel(spark, sf_dir)
    return comparable(clv_trend_by_tier(rolling, intel, tier="High"))


@register("clv_cumulative_by_tier", with_ctes(
    "SELECT clv_tier, order_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue, "
    "CAST(sum(daily_revenue) OVER (PARTITION BY clv_tier ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND CURRENT ROW) AS DOUBLE) AS cumulative_clv FROM (SELECT clv_tier, order_date, sum(order_revenue) AS "
    "daily_revenue FROM order_metrics JOIN intel USING (user_id) GROUP BY clv_tier, order_date)"))
def q_clv_cumulative_by_tier(spark, sf_dir):
    rolling, intel = _rolling_and_intel(spark, sf_dir)
    return comparable(clv_cumulative_by_tier(rolling, intel))


@register("segment_counts", with_ctes(
    "SELECT CAST(count(*) AS BIGINT) AS total_customers, "
    + ", ".join(f"CAST(count(*) FILTER (WHERE segment = '{s}') AS BIGINT) AS {s.lower().replace(' ', '_')}"
                for s in SEGMENTS) + " FROM intel"))
def q_segment_counts(spark, sf_dir):
    return segment_counts(_intel(spark, sf_dir))


@register("segment_share", with_ctes(
    "SELECT segment, customers, " + PCT.format(n="customers", d="sum(customers) OVER ()") + " AS share_pct "
    "FROM (SELECT segment, CAST(count(*) AS BIGINT) AS customers FROM intel GROUP BY segment)"))
def q_segment_share(spark, sf_dir):
    return segment_share(_intel(spark, sf_dir))


@register("churn_risk_pct", with_ctes(
    "SELECT churn_risk, total_customers, " + PCT.format(n="churn_risk", d="total_customers")
    + " AS churn_risk_pct FROM (SELECT CAST(count(*) FILTER (WHERE segment = 'Churn Risk') AS BIGINT) AS churn_risk,"
    " CAST(count(*) AS BIGINT) AS total_customers FROM intel)"))
def q_churn_risk_pct(spark, sf_dir):
    return churn_risk_pct(_intel(spark, sf_dir))


@register("high_tier_activity", with_ctes(
    "SELECT CAST(count(*) AS BIGINT) AS total_high, CAST(count(*) FILTER (WHERE frequency > 0) AS BIGINT) AS active, "
    "CAST(count(*) FILTER (WHERE frequency = 0) AS BIGINT) AS inactive FROM intel WHERE clv_tier = 'High'"))
def q_high_tier_activity(spark, sf_dir):
    return high_tier_activity(_intel(spark, sf_dir))


@register("high_tier_freq_hist", with_ctes(
    "SELECT bin, lo + (bin - 1) * ((hi - lo) / 20.0) AS bin_start, CAST(count(*) AS BIGINT) AS customers FROM ("
    " SELECT CASE WHEN hi = lo THEN 1 ELSE least(CAST(floor((f - lo) / ((hi - lo) / 20.0)) AS BIGINT) + 1, 20) END"
    " AS bin, lo, hi FROM (SELECT CAST(frequency AS DOUBLE) AS f FROM intel WHERE clv_tier = 'High') h,"
    " (SELECT min(CAST(frequency AS DOUBLE)) AS lo, max(CAST(frequency AS DOUBLE)) AS hi FROM intel"
    "  WHERE clv_tier = 'High') b) GROUP BY bin, lo, hi"))
def q_high_tier_freq_hist(spark, sf_dir):
    return high_tier_freq_hist(_intel(spark, sf_dir))


@register("winback_list", with_ctes(
    "SELECT user_id, " + dbl("current_clv") + ", " + big("recency") + ", " + big("frequency")
    + " FROM intel WHERE clv_tier = 'High' AND segment = 'Churn Risk'"))
def q_winback_list(spark, sf_dir):
    return comparable(winback_list(_intel(spark, sf_dir)))


@register("winback_formatted", with_ctes(
    "SELECT user_id, format('${:,.2f}', CAST(current_clv AS DOUBLE)) AS current_clv, " + big("recency") + ", "
    + big("frequency") + " FROM intel WHERE clv_tier = 'High' AND segment = 'Churn Risk'"))
def q_winback_formatted(spark, sf_dir):
    return comparable(winback_formatted(_intel(spark, sf_dir)))


@register("trends_coerced", with_ctes(
    "SELECT CAST(order_date AS DATE) AS order_date, restaurant_id, item_category, "
    "TRY_CAST(CAST(daily_revenue AS VARCHAR) AS DOUBLE) AS daily_revenue, " + big("daily_order_count")
    + " FROM trends"))
def q_trends_coerced(spark, sf_dir):
    return comparable(coerce_trends(_trends(spark, sf_dir)))


@register("location_count", with_ctes(
    "SELECT CAST(count(DISTINCT restaurant_id) AS BIGINT) AS locations FROM trends"))
def q_location_count(spark, sf_dir):
    return location_count(_trends(spark, sf_dir))


_SEL = "(SELECT DISTINCT restaurant_id FROM trends ORDER BY restaurant_id LIMIT 3)"


def _grain_sql(label: str) -> str:
    return with_ctes(
        f"SELECT {label} AS order_date, restaurant_id, CAST(sum(daily_revenue) AS DOUBLE) AS daily_revenue "
        f"FROM trends WHERE restaurant_id IN {_SEL} GROUP BY 1, 2")


@register("trend_daily", _grain_sql("order_date"))
def q_trend_daily(spark, sf_dir):
    return comparable(revenue_by_grain(_trends(spark, sf_dir), "daily"))


@register("trend_weekly", _grain_sql("CAST(order_date + CAST((7 - dayofweek(order_date)) % 7 AS INTEGER) AS DATE)"))
def q_trend_weekly(spark, sf_dir):
    return comparable(revenue_by_grain(_trends(spark, sf_dir), "weekly"))


@register("trend_monthly", _grain_sql("last_day(order_date)"))
def q_trend_monthly(spark, sf_dir):
    return comparable(revenue_by_grain(_trends(spark, sf_dir), "monthly"))


@register("category_mix", with_ctes(
    "SELECT item_category, CAST(sum(daily_revenue) AS DOUBLE) AS daily_revenue FROM trends "
    f"WHERE restaurant_id IN {_SEL} GROUP BY item_category"))
def q_category_mix(spark, sf_dir):
    return comparable(category_mix(_trends(spark, sf_dir)))


_PERF = """perf AS (
  SELECT *, row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, restaurant_id) AS revenue_rank FROM (
    SELECT restaurant_id, total_revenue, days_active, avg_daily_revenue, avg_daily_orders,
           CAST(total_revenue AS DOUBLE) / nullif(avg_daily_orders * CAST(days_active AS DOUBLE), 0) AS avg_order_value
    FROM (SELECT restaurant_id, sum(daily_revenue) AS total_revenue,
                 CAST(sum(daily_revenue) AS DOUBLE) / nullif(count(daily_revenue), 0) AS avg_daily_revenue,
                 CAST(sum(daily_order_count) AS DOUBLE) / nullif(count(daily_order_count), 0) AS avg_daily_orders,
                 count(DISTINCT order_date) AS days_active
          FROM trends GROUP BY restaurant_id)))"""

PERF_COLS = ("restaurant_id, " + dbl("total_revenue") + ", " + big("days_active")
             + ", avg_daily_revenue, avg_daily_orders, avg_order_value, " + big("revenue_rank"))


@register("store_performance", with_ctes(f"SELECT {PERF_COLS} FROM perf", _PERF))
def q_store_performance(spark, sf_dir):
    return comparable(store_performance(_trends(spark, sf_dir)))


@register("store_performance_exact", with_ctes(
    "SELECT restaurant_id, " + dbl("total_revenue") + ", " + big("days_active") + ", avg_daily_revenue, "
    "avg_daily_orders, avg_order_value, CAST(row_number() OVER (ORDER BY total_revenue DESC NULLS LAST, "
    "restaurant_id) AS BIGINT) AS revenue_rank FROM ("
    " SELECT restaurant_id, sum(rev) AS total_revenue, count(*) AS days_active,"
    " CAST(sum(rev) AS DOUBLE) / nullif(count(rev), 0) AS avg_daily_revenue,"
    " CAST(sum(orders) AS DOUBLE) / count(*) AS avg_daily_orders,"
    " CAST(sum(rev) AS DOUBLE) / nullif(sum(orders), 0) AS avg_order_value FROM ("
    "  SELECT restaurant_id, order_date, sum(total_line_item_revenue) AS rev, count(DISTINCT order_id) AS orders"
    "  FROM sales GROUP BY restaurant_id, order_date) GROUP BY restaurant_id)"))
def q_store_performance_exact(spark, sf_dir):
    return comparable(store_performance_exact(sales(spark, sf_dir)))


@register("store_extremes", with_ctes(
    "SELECT max(CASE WHEN revenue_rank = 1 THEN restaurant_id END) AS best_restaurant,"
    " CAST(max(CASE WHEN revenue_rank = 1 THEN total_revenue END) AS DOUBLE) AS best_revenue,"
    " max(CASE WHEN revenue_rank = 2 THEN restaurant_id END) AS second_restaurant,"
    " CAST(max(CASE WHEN revenue_rank = 2 THEN total_revenue END) AS DOUBLE) AS second_revenue,"
    " arg_max(restaurant_id, revenue_rank) AS worst_restaurant,"
    " CAST(arg_max(total_revenue, revenue_rank) AS DOUBLE) AS worst_revenue,"
    " CAST(max(revenue_rank) AS BIGINT) AS restaurants FROM perf", _PERF))
def q_store_extremes(spark, sf_dir):
    return comparable(store_extremes(store_performance(_trends(spark, sf_dir))))


@register("store_gap", with_ctes(
    "SELECT top_revenue, second_revenue, fleet_avg, top_revenue - second_revenue AS gap_to_second,"
    " (top_revenue - fleet_avg) / nullif(fleet_avg, 0) * 100 AS pct_above_avg FROM ("
    " SELECT CAST(max(CASE WHEN revenue_rank = 1 THEN total_revenue END) AS DOUBLE) AS top_revenue,"
    " CAST(max(CASE WHEN revenue_rank = 2 THEN total_revenue END) AS DOUBLE) AS second_revenue,"
    " CAST(sum(total_revenue) AS DOUBLE) / count(total_revenue) AS fleet_avg FROM perf)", _PERF))
def q_store_gap(spark, sf_dir):
    df = store_gap(store_performance(_trends(spark, sf_dir)))
    return comparable(df.withColumn("gap_to_second", as_double("top_revenue") - as_double("second_revenue")))


@register("store_leaders", with_ctes(
    "SELECT arg_max(restaurant_id, (avg_order_value, -revenue_rank)) AS whale_restaurant,"
    " max(avg_order_value) AS whale_aov,"
    " arg_max(restaurant_id, (avg_daily_orders, -revenue_rank)) AS volume_restaurant,"
    " max(avg_daily_orders) AS volume_avg_daily_orders, round(avg(avg_order_value), 6) AS fleet_avg_aov FROM perf",
    _PERF))
def q_store_leaders(spark, sf_dir):
    df = store_leaders(store_performance(_trends(spark, sf_dir)))
    return df.withColumn("fleet_avg_aov", F.round("fleet_avg_aov", 6))


@register("loyalty_labels", with_ctes(
    "SELECT is_loyalty, CASE lower(CAST(is_loyalty AS VARCHAR)) WHEN 'true' THEN 'Loyalty Member' WHEN '1' THEN "
    "'Loyalty Member' WHEN 'false' THEN 'Non-Member' WHEN '0' THEN 'Non-Member' END AS status, "
    + big("total_customers") + ", avg_order_value, repeat_order_rate, " + dbl("total_lifetime_value")
    + " FROM loyalty"))
def q_loyalty_labels(spark, sf_dir):
    return comparable(loyalty_labels(gold(spark, sf_dir, "loyalty_roi_analysis")))


@register("loyalty_compare", with_ctes(
    "SELECT member_aov, non_member_aov, member_repeat_rate, non_member_repeat_rate,"
    " (member_aov - non_member_aov) / nullif(non_member_aov, 0) * 100 AS aov_diff_pct,"
    " (member_repeat_rate - non_member_repeat_rate) / nullif(non_member_repeat_rate, 0) * 100 AS repeat_diff_pct,"
    " " + PCT.format(n="member_ltv", d="all_ltv") + " AS loyalty_revenue_share_pct FROM ("
    " SELECT max(CASE WHEN is_loyalty THEN avg_order_value END) AS member_aov,"
    " max(CASE WHEN NOT is_loyalty THEN avg_order_value END) AS non_member_aov,"
    " max(CASE WHEN is_loyalty THEN repeat_order_rate END) AS member_repeat_rate,"
    " max(CASE WHEN NOT is_loyalty THEN repeat_order_rate END) AS non_member_repeat_rate,"
    " max(CASE WHEN is_loyalty THEN total_lifetime_value END) AS member_ltv,"
    " sum(total_lifetime_value) AS all_ltv FROM loyalty)"))
def q_loyalty_compare(spark, sf_dir):
    return loyalty_compare(gold(spark, sf_dir, "loyalty_roi_analysis"))


@register("loyalty_ltv", with_ctes(
    "SELECT is_loyalty, CASE WHEN is_loyalty THEN 'Loyalty Member' WHEN NOT is_loyalty THEN 'Non-Member' END AS "
    "status, " + big("total_customers") + ", " + dbl("total_lifetime_value") + ", "
    + PCT.format(n="total_lifetime_value", d="total_customers").replace(" * 100", "")
    + " AS avg_ltv_per_customer FROM loyalty"))
def q_loyalty_ltv(spark, sf_dir):
    return comparable(loyalty_ltv(gold(spark, sf_dir, "loyalty_roi_analysis")))


@register("discount_roi", with_ctes(
    "SELECT discounted_orders, full_price_orders, discounted_revenue, full_price_revenue, discounted_aov,"
    " full_price_aov, (discounted_aov - full_price_aov) / nullif(full_price_aov, 0) * 100 AS aov_lift_pct,"
    " " + PCT.format(n="discounted_orders", d="discounted_orders + full_price_orders")
    + " AS discounted_order_share_pct, "
    + PCT.format(n="discounted_revenue", d="discounted_revenue + full_price_revenue")
    + " AS discounted_revenue_share_pct FROM ("
    " SELECT CAST(max(CASE WHEN is_discounted = 1 THEN order_count END) AS BIGINT) AS discounted_orders,"
    " CAST(max(CASE WHEN is_discounted <> 1 THEN order_count END) AS BIGINT) AS full_price_orders,"
    " CAST(max(CASE WHEN is_discounted = 1 THEN total_revenue END) AS DOUBLE) AS discounted_revenue,"
    " CAST(max(CASE WHEN is_discounted <> 1 THEN total_revenue END) AS DOUBLE) AS full_price_revenue,"
    " max(CASE WHEN is_discounted = 1 THEN avg_order_value END) AS discounted_aov,"
    " max(CASE WHEN is_discounted <> 1 THEN avg_order_value END) AS full_price_aov FROM discount)"))
def q_discount_roi(spark, sf_dir):
    return comparable(discount_roi(comparable(gold(spark, sf_dir, "discount_effectiveness"))))
