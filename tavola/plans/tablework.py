"""Table work around the pipeline: change feeds, validation, quality, calendar, SQL access."""

from __future__ import annotations

import math
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import parse_date_key
from ..operators.cdc import apply_changes
from ..operators.materialize import materialize
from ..operators.quality import dq_report, split_valid, validate_table
from ..session import ensure_checkpoint_dir
from ..sources import sinks, star
from ..sources.bronze import read_bronze, read_parquet
from ..streaming import ingest
from . import clean as C
from . import metrics as M
from .oracle_sql import NEWCOMERS, NULL_ORDERS, OUTCOME, RAW_ITEMS
from .registry import big, bronze, comparable, dbl, gold, register, sales, silver, with_ctes


def sales_by_calendar(sales_df: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue, orders and lines by weekday, weekend and holiday flags.

    A day that stands in the calendar more than once counts once, with the
    smallest of its rows.
    """
    cal = one_row_per_day(dates, "day_of_week", "is_weekend", "is_holiday").withColumnRenamed("date_key", "_d")
    joined = sales_df.join(cal, sales_df["order_date"] == cal["_d"], "left")
    return (joined.groupBy("day_of_week", "is_weekend", "is_holiday")
            .agg(F.sum("total_line_item_revenue").alias("revenue"),
                 F.count_distinct("order_id").alias("orders"), F.count(F.lit(1)).alias("lines")))


def one_row_per_day(dates: DataFrame, *columns: str) -> DataFrame:
    """``date_key`` and the given columns of a calendar, one row per day."""
    return (dates.filter("date_key is not null").groupBy("date_key").agg(F.min(F.struct(*columns)).alias("_row"))
            .select("date_key", *[F.col("_row")[c].alias(c) for c in columns]))


def change_base(items: DataFrame, *more: str) -> DataFrame:
    """The full load as version 0 of a change feed (``seq`` 0, op ``I``), with ``more`` of its columns."""
    return items.select(*more, "order_id", "lineitem_id", "item_name", "item_price", "item_quantity",
                        F.col("creation_time_utc").alias("commit_ts"), F.lit(0).alias("seq"),
                        F.lit("I").alias("op"), F.lit(None).cast("bigint").alias("l_partkey"),
                        F.lit(None).cast("bigint").alias("l_suppkey"),
                        F.lit(None).cast("double").alias("l_extendedprice"))


CDC_OUT = ("order_id", "lineitem_id", "item_name", "item_price", "item_quantity", "commit_ts", "op")

CDC_SQL = """cdc_all AS (
  SELECT order_id, lineitem_id, item_name, item_price, item_quantity, creation_time_utc AS commit_ts, 0 AS seq,
         'I' AS op, CAST(NULL AS BIGINT) AS l_partkey, CAST(NULL AS BIGINT) AS l_suppkey,
         CAST(NULL AS DOUBLE) AS l_extendedprice FROM c_items
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), p_name,
         CAST(CASE WHEN p_name LIKE 'small%' OR l_discount = 0 THEN 0 ELSE p_retailprice END AS DECIMAL(12,2)),
         CAST(l_quantity AS INT), CAST(l_shipdate AS TIMESTAMP), 1,
         CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
cdc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id, lineitem_id ORDER BY commit_ts DESC NULLS LAST,
         seq DESC, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST) AS rn
         FROM cdc_all) WHERE rn = 1 AND op <> 'D'
)"""

CDC_SELECT = with_ctes("SELECT order_id, lineitem_id, item_name, " + dbl("item_price") + ", "
                       + big("item_quantity") + ", commit_ts, op FROM cdc", CDC_SQL)


def _clean_items(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return C.clean_order_items(b.order_items, b.dedup_order, b.drop_after_dedup)


@register("cdc_apply", CDC_SELECT)
def q_cdc_apply(spark, sf_dir):
    base = change_base(_clean_items(spark, sf_dir))
    out = apply_changes(base, star.item_changes(spark, sf_dir), schemas.ITEM_KEYS, star.CHANGE_ORDER)
    return comparable(out.select(*CDC_OUT))


FEED_BATCHES = 4   # fixed value: micro-batches the landed feed is applied in


def _land(changes: DataFrame, root: str) -> tuple[str, int]:
    """The feed as files, as its tasks write them, and their number; a feed of too few files for its batches is dealt first."""
    spark, source = changes.sparkSession, f"{root}/source"
    count = lambda path: len(spark.read.schema(changes.schema).parquet(path).inputFiles())
    with sinks._setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        changes.write.parquet(source)
    if count(source) < FEED_BATCHES:
        few, source = source, f"{root}/dealt"
        files = max(FEED_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.read.schema(changes.schema).parquet(few).repartition(files).write.parquet(source)
    return source, count(source)


@register("cdc_stream_apply", CDC_SELECT)
def q_cdc_stream_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same change feed landed as files and applied by the incremental stream in several batches."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tavola-cdc-{uuid.uuid4().hex}"
    changes = star.item_changes(spark, sf_dir)
    source, landed = _land(changes, root)
    ingest.write_initial_state(change_base(_clean_items(spark, sf_dir)), f"{root}/state", schemas.ITEM_KEYS)
    q = ingest.start_ingest(spark, source, changes.schema, f"{root}/state", f"{root}/checkpoint",
                            schemas.ITEM_KEYS, star.CHANGE_ORDER, available_now=True,
                            max_files_per_trigger=max(1, math.ceil(landed / FEED_BATCHES)))
    q.awaitTermination()
    return comparable(ingest.current_rows(spark, f"{root}/state").select(*CDC_OUT))


@register("ingest_validation", with_ctes(
    "SELECT 'order_items' AS table_name, CAST(count(*) AS BIGINT) AS row_count,"
    " CAST(count(*) FILTER (WHERE order_id IS NULL OR lineitem_id IS NULL) AS BIGINT) AS null_key_rows,"
    " min(CAST(creation_time_utc AS DATE)) AS min_date, max(CAST(creation_time_utc AS DATE)) AS max_date,"
    " '' AS missing_columns FROM f_items UNION ALL "
    "SELECT 'order_item_options', count(*), count(*) FILTER (WHERE order_id IS NULL OR lineitem_id IS NULL),"
    " CAST(NULL AS DATE), CAST(NULL AS DATE), '' FROM f_opts UNION ALL "
    "SELECT 'date_dim', count(*), count(*) FILTER (WHERE date_key IS NULL),"
    " min(try_strptime(date_key, '%d-%m-%Y')::DATE), max(try_strptime(date_key, '%d-%m-%Y')::DATE), ''"
    " FROM raw_dates"))
def q_ingest_validation(spark, sf_dir):
    b = bronze(spark, sf_dir)
    items = b.order_items.drop(*b.drop_after_dedup)
    return (validate_table(items, "order_items", schemas.ITEM_KEYS, F.to_date("creation_time_utc"),
                           schemas.ORDER_ITEMS)
            .unionByName(validate_table(b.order_item_options, "order_item_options", schemas.ITEM_KEYS, None,
                                        schemas.ORDER_ITEM_OPTIONS))
            .unionByName(validate_table(b.date_dim, "date_dim", ("date_key",), parse_date_key("date_key"),
                                        schemas.DATE_DIM)))


@register("dq_report", with_ctes(f"SELECT {OUTCOME} AS outcome, CAST(count(*) AS BIGINT) AS rows FROM f_items GROUP BY 1",
                                 items=RAW_ITEMS))
def q_dq_report(spark, sf_dir):
    return dq_report(star.raw_order_items(spark, sf_dir))


@register("quarantine_items", with_ctes(
    f"SELECT {OUTCOME} AS reject_reason, lineitem_id, " + dbl("item_price") + ", " + big("item_quantity") + ", item_name"
    " FROM f_items WHERE reject_reason <> 'valid'", items=RAW_ITEMS))
def q_quarantine_items(spark, sf_dir):
    """Rejected order lines, read back from the written quarantine."""
    path = _folder(spark, "quarantine")
    sinks.write_table(split_valid(star.raw_order_items(spark, sf_dir))[1], path)
    return comparable(spark.read.parquet(path).select("reject_reason", "lineitem_id", "item_price", "item_quantity", "item_name"))


def _defective_sales(spark, sf_dir):
    return C.clean(replace(bronze(spark, sf_dir), order_items=star.null_order_items(spark, sf_dir)))[0]


@register("discount_null_orders", with_ctes(
    "SELECT " + big("is_discounted") + ", " + big("order_count") + ", " + dbl("total_revenue") + ", avg_order_value FROM discount",
    items=NULL_ORDERS))
def q_discount_null_orders(spark, sf_dir):
    """Discount effectiveness where some lines have no order id."""
    return comparable(M.discount_effectiveness(_defective_sales(spark, sf_dir)))


@register("segments_with_newcomers", with_ctes(
    "SELECT segment, clv_tier, churn_status, CAST(count(*) AS BIGINT) AS customers FROM intel GROUP BY ALL", items=NEWCOMERS))
def q_segments_with_newcomers(spark, sf_dir):
    """Segments where most customers order often and others come back rarely: every segment occurs, no line is left out."""
    s = C.clean(replace(bronze(spark, sf_dir), order_items=star.newcomer_order_items(spark, sf_dir)))[0]
    return M.customer_intelligence(s).groupBy("segment", "clv_tier", "churn_status").agg(F.count(F.lit(1)).alias("customers"))


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tavola-{name}-{uuid.uuid4().hex[:12]}"


@register("utc_order_dates", with_ctes(
    "SELECT CAST(creation_time_utc - INTERVAL 330 MINUTE AS DATE) AS order_date, CAST(count(*) AS BIGINT) AS lines FROM items GROUP BY 1"))
def q_utc_order_dates(spark, sf_dir):
    """Order dates of lines whose times were recorded at UTC+05:30."""
    b = bronze(spark, sf_dir)
    items = C.clean_order_items(C.to_utc_times(b.order_items, "+05:30"), b.dedup_order, b.drop_after_dedup)
    return items.groupBy("order_date").agg(F.count(F.lit(1)).alias("lines"))


@register("csv_bronze_sales", with_ctes(
    "SELECT order_id, is_loyalty, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue, CAST(count(*) AS BIGINT) AS lines"
    " FROM sales GROUP BY ALL"))
def q_csv_bronze_sales(spark, sf_dir):
    """Bronze exported as CSV, read back as text, typed, cleaned and joined."""
    root, b = _folder(spark, "csv"), bronze(spark, sf_dir)
    items = C.dedup_order_items(b.order_items, b.dedup_order).drop(*b.drop_after_dedup)
    for name, df in (("order_items", items), ("order_item_options", b.order_item_options), ("date_dim", b.date_dim)):
        df.write.option("header", "true").csv(f"{root}/{name}")
    s = C.clean(read_bronze(spark, root, "csv"))[0]
    return comparable(s.groupBy("order_id", "is_loyalty").agg(F.sum("total_line_item_revenue").alias("revenue"),
                                                              F.count(F.lit(1)).alias("lines")))


@register("parquet_drift_items", with_ctes(
    "SELECT CASE WHEN is_loyalty THEN user_id END AS user_id, is_loyalty, CAST(sum(item_quantity) AS BIGINT) AS quantity,"
    " CAST(sum(item_price) AS DOUBLE) AS price FROM f_items GROUP BY ALL"))
def q_parquet_drift_items(spark, sf_dir):
    """Nested folders of two layouts: the older one has upper-case names, booleans as numbers and no user id."""
    root, fields = _folder(spark, "drift"), [f.name for f in schemas.ORDER_ITEMS.fields]
    items = materialize(bronze(spark, sf_dir).order_items.select(*fields), "drift-items")   # both layouts are written from it
    old = items.filter(~F.col("is_loyalty")).select(*[F.col(c).alias(c.upper()) for c in fields if c not in ("user_id", "is_loyalty")],
                                                    F.lit("0").alias("IS_LOYALTY"))
    old.write.parquet(f"{root}/2023/12/31")
    items.filter("is_loyalty").select(*[F.col(c).cast("string") if c == "is_loyalty" else F.col(c) for c in fields]) \
        .write.parquet(f"{root}/2024/01/01")
    got = read_parquet(spark, root, schemas.ORDER_ITEMS, merge_schema=True)
    return comparable(got.groupBy("user_id", "is_loyalty").agg(F.sum("item_quantity").alias("quantity"),
                                                               F.sum("item_price").alias("price")))


@register("sales_by_calendar", with_ctes(
    "SELECT day_of_week, is_weekend, is_holiday, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue,"
    " CAST(count(DISTINCT order_id) AS BIGINT) AS orders, CAST(count(*) AS BIGINT) AS lines"
    " FROM sales LEFT JOIN dates ON sales.order_date = dates.date_key GROUP BY ALL"))
def q_sales_by_calendar(spark, sf_dir):
    s, d = silver(spark, sf_dir)
    return comparable(sales_by_calendar(s, d))


@register("sql_location_trends", with_ctes(
    "SELECT restaurant_id, CAST(sum(daily_revenue) AS DOUBLE) AS revenue, "
    "CAST(sum(daily_order_count) AS BIGINT) AS order_count FROM trends GROUP BY restaurant_id"))
def q_sql_location_trends(spark, sf_dir):
    """A Gold table reached through SQL on a temp view."""
    gold(spark, sf_dir, "location_sales_trends").createOrReplaceTempView("location_sales_trends")
    return spark.sql("SELECT restaurant_id, CAST(sum(daily_revenue) AS DOUBLE) AS revenue, "
                     "CAST(sum(daily_order_count) AS BIGINT) AS order_count "
                     "FROM location_sales_trends GROUP BY restaurant_id")


PREVIEW_ORDER = ("order_id", "lineitem_id", "option_name", "option_price", "option_quantity")


@register("preview_sales", with_ctes(
    "SELECT order_id, lineitem_id, item_name, option_name, " + dbl("option_price") + ", " + big("option_quantity")
    + ", " + dbl("total_line_item_revenue") + " FROM sales ORDER BY order_id NULLS FIRST, lineitem_id NULLS FIRST,"
    " option_name NULLS FIRST, option_price NULLS FIRST, option_quantity NULLS FIRST LIMIT 10"))
def q_preview_sales(spark, sf_dir):
    s = sales(spark, sf_dir)
    return comparable(s.orderBy(*PREVIEW_ORDER).limit(10)
                      .select("order_id", "lineitem_id", "item_name", "option_name", "option_price",
                              "option_quantity", "total_line_item_revenue"))


RANGE = ("2000-01-01", "2000-03-31")   # fixed value: the date-scoped report's quarter


@register("sales_by_date_range", with_ctes(
    "SELECT order_date, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue,"
    " CAST(count(DISTINCT order_id) AS BIGINT) AS orders FROM sales"
    f" WHERE order_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' GROUP BY order_date"))
def q_sales_by_date_range(spark, sf_dir):
    """A quarter of written Silver: only its date folders are read."""
    path = _folder(spark, "silver")
    sinks.write_partitioned(sales(spark, sf_dir), path, "order_date")
    s = sinks.read_silver(spark, path, *RANGE)
    return comparable(s.groupBy("order_date").agg(F.sum("total_line_item_revenue").alias("revenue"),
                                                   F.count_distinct("order_id").alias("orders")))


GRAIN = "month"   # partitions of the tables below: a day of the driver's tables holds a few hundred lines


def _daily(s: DataFrame) -> DataFrame:
    """Revenue and lines by day and restaurant of a written table, all of it."""
    return comparable(s.groupBy("order_date", "restaurant_id").agg(F.sum("total_line_item_revenue").alias("revenue"),
                                                                   F.count(F.lit(1)).alias("lines")))


DAILY = ("SELECT order_date, restaurant_id, CAST({} * sum(total_line_item_revenue) AS DOUBLE) AS revenue,"
         " CAST(count(*) AS BIGINT) AS lines FROM sales {} GROUP BY order_date, restaurant_id")


def _rewritten(spark, sf_dir, dynamic: bool) -> DataFrame:
    """All lines of all days written, then those of every March again with doubled revenue."""
    path = _folder(spark, "overwrite")
    sinks.write_partitioned(sales(spark, sf_dir), path, "order_date", grain=GRAIN)
    s = spark.read.parquet(path)
    march = s.filter(F.month(sinks.partition_column("order_date", GRAIN)) == 3).drop(sinks.partition_column("order_date", GRAIN))
    doubled = (F.col("total_line_item_revenue") * 2).cast(s.schema["total_line_item_revenue"].dataType)
    march = materialize(march.withColumn("total_line_item_revenue", doubled), "march")   # a static overwrite must not read its target
    sinks.write_partitioned(march, path, "order_date", dynamic=dynamic, grain=GRAIN)
    return _daily(spark.read.parquet(path))


@register("overwrite_days_dynamic", with_ctes(DAILY.format("CASE WHEN month(order_date) = 3 THEN 2 ELSE 1 END", "")))
def q_overwrite_days_dynamic(spark, sf_dir):
    """March rewritten in place, the other days kept."""
    return _rewritten(spark, sf_dir, dynamic=True)


@register("overwrite_days_static", with_ctes(DAILY.format("2", "WHERE month(order_date) = 3")))
def q_overwrite_days_static(spark, sf_dir):
    """A static overwrite leaves only what the second write held."""
    return _rewritten(spark, sf_dir, dynamic=False)


SUMMARY_SQL = with_ctes("SELECT is_loyalty, CAST(sum(order_revenue) AS DOUBLE) AS revenue, CAST(count(*) AS BIGINT) AS orders"
                        " FROM order_summary GROUP BY is_loyalty")


def _summary_written(spark, sf_dir, legacy: bool) -> DataFrame:
    path = _folder(spark, "plain")
    for _ in range(2):   # the second write replaces the first
        sinks.write_table(M.order_summary(sales(spark, sf_dir)), path, legacy_format=legacy)
    return comparable(spark.read.parquet(path).groupBy("is_loyalty").agg(F.sum("order_revenue").alias("revenue"),
                                                                         F.count(F.lit(1)).alias("orders")))


@register("write_plain_table", SUMMARY_SQL)
def q_write_plain_table(spark, sf_dir):
    return _summary_written(spark, sf_dir, legacy=False)


@register("write_legacy_table", SUMMARY_SQL)
def q_write_legacy_table(spark, sf_dir):
    return _summary_written(spark, sf_dir, legacy=True)


LOADS = 4   # fixed value: parts of a month, written by different tasks, whose small files are compacted


@register("compacted_days", with_ctes(DAILY.format("1", "")))
def q_compacted_days(spark, sf_dir):
    """All lines of all days: the months of odd years lie in several small files, which compaction finds and rewrites."""
    path = _folder(spark, "compact")
    load = F.when(F.year("order_date") % 2 == 1, F.pmod(F.xxhash64("order_id"), F.lit(LOADS)))   # an order's rows lie together
    part = sinks.partition_column("order_date", GRAIN)
    with sinks._setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        (sales(spark, sf_dir).withColumn(part, F.trunc("order_date", GRAIN)).withColumn("_load", load)
         .hint("rebalance", part, "_load").drop("_load").write.partitionBy(part).parquet(path))
    sinks.compact_partitions(spark, path, part)
    return _daily(spark.read.parquet(path))


@register("catalog_revenue", with_ctes(DAILY.format("1", "")))
def q_catalog_revenue(spark, sf_dir):
    """Written Silver, all lines of all days, queried through the catalog."""
    path = _folder(spark, "catalog")
    sinks.write_partitioned(sales(spark, sf_dir), f"{path}/sales_fact", "order_date", grain=GRAIN)
    sinks.register_tables(spark, path, ["sales_fact"], database="tavola_reports")
    return _daily(spark.sql("SELECT order_date, restaurant_id, total_line_item_revenue FROM tavola_reports.sales_fact"))
