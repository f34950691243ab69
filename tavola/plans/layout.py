"""Queries that depend on how tables lie: pruning through the calendar, order counts that add up, co-located tables."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import scratch_folder
from ..operators.ordering import PART, PLACE, Key, RangeConfig, ranked
from ..sources import sinks
from . import clean as C
from . import metrics as M
from .oracle_sql import with_ctes
from .registry import ORACLE, bronze, comparable, register, sales, silver
from .tablework import one_row_per_day

# --- D8, D9: only the folders of the days a calendar names -----------------------------------------------------------


EARLIEST = "0001-01-01"   # fixed value: no date is earlier


def sales_on_days(written: DataFrame, days: DataFrame) -> DataFrame:
    """Written Silver joined to a filtered calendar (``date_key``, one row per day).

    Silver's partition column is part of the join, so Spark prunes folders by
    the days found at run time: those of no such day are not read.
    """
    days = days.filter(F.col("date_key") >= F.lit(EARLIEST).cast("date"))   # Spark prunes by a side with a comparison only
    joined = written["order_date"] == days["date_key"]
    for grain in ("month", "quarter", "year"):
        column = sinks.partition_column("order_date", grain)
        if column in written.columns:
            days = days.withColumn(f"_{grain}", F.trunc("date_key", grain))
            joined = joined & (written[column] == days[f"_{grain}"])
    return written.join(days, joined).drop(*[c for c in days.columns if c.startswith("_")])


@register("holiday_sales", with_ctes(
    "SELECT holiday_name, order_date, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue,"
    " CAST(count(DISTINCT order_id) AS BIGINT) AS orders, CAST(count(*) AS BIGINT) AS lines"
    " FROM sales JOIN dates ON sales.order_date = dates.date_key WHERE is_holiday GROUP BY holiday_name, order_date"))
def q_holiday_sales(spark, sf_dir):
    """Holidays' sales from written Silver: only the months with a holiday are read."""
    root = scratch_folder(spark, "holidays")
    s, d = silver(spark, sf_dir)
    sinks.write_partitioned(s, f"{root}/sales_fact", "order_date", grain="month")
    sinks.write_table(d, f"{root}/date_dim")
    days = one_row_per_day(spark.read.parquet(f"{root}/date_dim"), "is_holiday", "holiday_name").filter("is_holiday")
    found = sales_on_days(sinks.read_silver(spark, f"{root}/sales_fact"), days)
    return comparable(found.groupBy("holiday_name", "order_date").agg(
        F.sum("total_line_item_revenue").alias("revenue"), F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines")))


# --- T5, G17, Q-P1: distinct order counts that add up ----------------------------------------------------------------

def order_numbers(s: DataFrame, cfg: RangeConfig = RangeConfig()) -> DataFrame:
    """(order_id, order_no): orders numbered without gaps from 0, in order of their first date and id, so that the orders of a
    day lie next to each other. Null ids have no number."""
    first = M.checkpointed(s.filter("order_id is not null").groupBy("order_id").agg(F.min("order_date").alias("first_date")))
    dealt, ranges = ranked(first, [Key("first_date"), Key("order_id")], cfg)
    return dealt.join(ranges, PART).select("order_id", (F.col("_before") + F.col(PLACE)).alias("order_no"))


def daily_order_bitmaps(s: DataFrame, numbers: DataFrame) -> DataFrame:
    """The orders of each day and restaurant as bitmaps over the order numbers: one row (4 KB) per 32,768 numbers that the
    day's orders fall into, mostly one."""
    daily = s.select("order_date", "restaurant_id", "order_id").distinct().join(numbers, "order_id")
    return daily.groupBy("order_date", "restaurant_id", F.bitmap_bucket_number("order_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_no")).alias("orders"))


def order_counts(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Distinct orders per group of days and restaurants, from the daily bitmaps alone."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("orders")).alias("orders"))
    return merged.groupBy(*by).agg(F.sum("orders").alias("orders"))


@register("order_counts_from_days", with_ctes(
    "SELECT restaurant_id, CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(count(DISTINCT order_id) AS BIGINT) AS orders"
    " FROM sales GROUP BY GROUPING SETS ((restaurant_id, date_trunc('month', order_date)), (restaurant_id), (date_trunc('month', order_date)), ())"))
def q_order_counts_from_days(spark, sf_dir):
    """Distinct orders by restaurant and month, by restaurant, by month and in all, each from the written daily table."""
    s = M.checkpointed(sales(spark, sf_dir).select("order_date", "restaurant_id", "order_id"))
    daily = M.checkpointed(daily_order_bitmaps(s, order_numbers(s))).withColumn("month", F.trunc("order_date", "month"))
    found = None
    for by in (("restaurant_id", "month"), ("restaurant_id",), ("month",), ()):
        part = order_counts(daily, *by)
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found.select("restaurant_id", "month", "orders")


# --- IO7, IO10: co-located tables ------------------------------------------------------------------------------------

DATABASE, BUCKET_BYTES = "tavola_layout", 32 << 20   # a bucket is one task's work


def write_bucketed(df: DataFrame, name: str, column: str, sort: tuple[str, ...], path: str, buckets: int | None = None,
                   database: str = DATABASE) -> DataFrame:
    """Write a catalog table at ``path``, bucketed by ``column`` and sorted within buckets, one file a bucket, with column
    statistics. Groupings and joins on the column need no shuffle of it."""
    spark = df.sparkSession
    if buckets is None:
        from ..operators.materialize import materialize, written_bytes
        df = materialize(df, "bucketed")
        buckets = max(1, math.ceil(written_bytes(df) / BUCKET_BYTES))
    full = f"`{database}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    (df.repartition(buckets, column).write.mode("overwrite").option("path", path).bucketBy(buckets, column).sortBy(*sort)
     .saveAsTable(full))
    spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(full)


def timeline_by_customer(spark: SparkSession, s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The order timeline as a table bucketed by customer, and the order roll-up it came from."""
    rollup = M.checkpointed(M.order_rollup(s))
    timeline = M.order_timeline(M.registered(rollup))
    return write_bucketed(timeline, f"order_timeline_{uuid.uuid4().hex[:12]}", "user_id", ("user_id", "order_date", "order_id"),
                          scratch_folder(spark, "timeline")), rollup


@register("customer_base_bucketed", ORACLE["customer_base"])
def q_customer_base_bucketed(spark, sf_dir):
    """``customer_base`` from a timeline that lies bucketed by customer: no shuffle on the customer."""
    timeline, rollup = timeline_by_customer(spark, sales(spark, sf_dir))
    return comparable(M.customer_base(timeline, M.reference_date(rollup)), round6=("avg_spend_change_pct",))


ORDER_TOTALS = with_ctes("""SELECT i.order_id, CAST(i.items AS DOUBLE) AS item_total, CAST(coalesce(o.options, 0) AS DOUBLE) AS option_total
FROM (SELECT order_id, sum(item_total) AS items FROM c_items GROUP BY order_id) i
LEFT JOIN (SELECT order_id, sum(option_total) AS options FROM c_opts GROUP BY order_id) o ON i.order_id = o.order_id""")


def order_totals(items: DataFrame, options: DataFrame) -> DataFrame:
    """Item and option totals per order, without the fan-out; from tables bucketed alike by order nothing is shuffled."""
    of_items = items.groupBy("order_id").agg(F.sum("item_total").alias("item_total"))
    of_options = options.groupBy("order_id").agg(F.sum("option_total").alias("option_total"))
    return of_items.join(of_options, "order_id", "left").select(
        "order_id", "item_total", F.coalesce("option_total", F.lit(0)).alias("option_total"))


def tables_by_order(spark: SparkSession, bronze, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Cleaned items and options as tables bucketed by order, in the same number of buckets."""
    from ..operators.materialize import materialize, written_bytes
    items = materialize(C.clean_order_items(bronze.order_items, bronze.dedup_order, bronze.drop_after_dedup), "by-order")
    options = C.clean_order_item_options(bronze.order_item_options)
    buckets = buckets or max(1, math.ceil(written_bytes(items) / BUCKET_BYTES))
    mark = uuid.uuid4().hex[:12]
    return tuple(write_bucketed(df, f"{name}_{mark}", "order_id", ("order_id", "lineitem_id"), scratch_folder(spark, name), buckets)
                 for name, df in (("order_items", items), ("order_item_options", options)))


@register("order_totals_bucketed", ORDER_TOTALS)
def q_order_totals_bucketed(spark, sf_dir):
    """Order totals from items and options that lie bucketed by order: neither grouping nor join shuffles."""
    return comparable(order_totals(*tables_by_order(spark, bronze(spark, sf_dir))))
