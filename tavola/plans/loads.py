"""Queries around loads and feeds: newest load, schema drift, checks over sets, stored results, Gold from the change feed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .. import schemas
from ..operators.materialize import materialize, scratch_folder
from ..operators.profile import merged_profile, profile_sketches
from ..operators.quality import set_checks, split_valid
from ..sources import star
from ..sources.bronze import latest_load, read_parquet
from ..sources.cache import cached
from . import clean as C
from . import incremental
from . import metrics as M
from .oracle_sql import RAW_ITEMS
from .registry import big, bronze, comparable, dbl, register, sales, with_ctes
from .tablework import CDC_SQL, change_base

# --- T9: one load ----------------------------------------------------------------------------------------------------

OPTION_TOTALS = with_ctes(
    "SELECT option_group_name, option_name, CAST(sum(total_line_item_revenue) AS DOUBLE) AS revenue, CAST(count(*) AS BIGINT) AS lines"
    " FROM sales GROUP BY option_group_name, option_name")


@register("latest_load_options", OPTION_TOTALS)
def q_latest_load_options(spark, sf_dir):
    """Three landed loads of the options: an older one, the newest complete one, and one that never finished."""
    root, b = scratch_folder(spark, "loads"), bronze(spark, sf_dir)
    options = b.order_item_options
    options.withColumn("option_price", (F.col("option_price") * 2).cast(schemas.MONEY)).write.parquet(f"{root}/2024/01/01")
    options.write.parquet(f"{root}/2024/01/02")
    options.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/2024/01/03")
    newest = read_parquet(spark, latest_load(spark, root), schemas.ORDER_ITEM_OPTIONS)
    s = C.clean(replace(b, order_item_options=newest))[0]
    return comparable(s.groupBy("option_group_name", "option_name").agg(F.sum("total_line_item_revenue").alias("revenue"),
                                                                        F.count(F.lit(1)).alias("lines")))


# --- D7: unknown columns and wider types kept ------------------------------------------------------------------------

NO_NUMBER_EVERY = 5   # fixed value: every fifth line number's quantities arrive as text that is no number

DRIFT_SQL = with_ctes(
    "SELECT is_loyalty, CASE WHEN is_loyalty THEN CAST(CAST(substr(restaurant_id, 2) AS INT) % 7 AS VARCHAR) END AS table_no,"
    f" CAST(sum(CASE WHEN is_loyalty AND CAST(lineitem_id AS INT) % {NO_NUMBER_EVERY} = 0 THEN NULL ELSE item_quantity END) AS BIGINT) AS quantity,"
    f" CAST(count(*) FILTER (WHERE is_loyalty AND CAST(lineitem_id AS INT) % {NO_NUMBER_EVERY} = 0) AS BIGINT) AS unread_quantities,"
    " CAST(sum(CASE WHEN is_loyalty THEN item_price + 0.005 ELSE item_price END) AS DOUBLE) AS exact_price"
    " FROM f_items GROUP BY ALL")


@register("drift_rescued", DRIFT_SQL)
def q_drift_rescued(spark, sf_dir):
    """A newer folder has a column more, prices with more digits and quantities that are not all numbers: what the declared
    schema cannot hold is read from the rescue column."""
    root, fields = scratch_folder(spark, "drift"), [f.name for f in schemas.ORDER_ITEMS.fields]
    items = materialize(bronze(spark, sf_dir).order_items.select(*fields), "drift-items")   # both folders are written from it
    old, new = items.filter(~F.col("is_loyalty")), items.filter("is_loyalty")
    unread = F.col("lineitem_id").cast("int") % NO_NUMBER_EVERY == 0
    new = (new.withColumn("item_price", (F.col("item_price") + F.lit("0.005").cast("decimal(4,3)")).cast("decimal(18,4)"))
           .withColumn("item_quantity", F.when(unread, F.concat(F.lit("x"), "item_quantity")).otherwise(F.col("item_quantity").cast("string")))
           .withColumn("table_no", (F.substring("restaurant_id", 2, 9).cast("int") % 7).cast("string")))
    old.write.parquet(f"{root}/2023/12/31")
    new.write.parquet(f"{root}/2024/01/01")
    read = [read_parquet(spark, f"{root}/{day}", schemas.ORDER_ITEMS, rescue="_rescued") for day in ("2023/12/31", "2024/01/01")]
    kept = lambda name: F.get_json_object("_rescued", f"$.{name}")
    both = read[0].unionByName(read[1])
    exact = F.coalesce(kept("item_price").cast("decimal(18,4)"), F.col("item_price"))
    return comparable(both.groupBy("is_loyalty", kept("table_no").alias("table_no")).agg(
        F.sum("item_quantity").alias("quantity"), F.count_if(kept("item_quantity").isNotNull()).alias("unread_quantities"),
        F.sum(exact).alias("exact_price")))


# --- D5, D6: checks over sets ----------------------------------------------------------------------------------------

SET_CHECKS_SQL = with_ctes("""SELECT check_name, CAST(failures AS BIGINT) AS failures, CAST(rows AS BIGINT) AS rows, failures = 0 AS passed FROM (
  SELECT 'options_without_line' AS check_name, (SELECT count(*) FROM f_opts o WHERE NOT EXISTS (
           SELECT 1 FROM v_items i WHERE i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id)) AS failures, (SELECT count(*) FROM f_opts) AS rows
  UNION ALL SELECT 'repeated_lines', (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM v_items GROUP BY order_id, lineitem_id)),
           (SELECT count(*) FROM v_items)
  UNION ALL SELECT 'orders_on_two_dates', (SELECT count(*) FROM (SELECT order_id FROM v_items WHERE order_id IS NOT NULL GROUP BY order_id
           HAVING min(d) <> max(d))), (SELECT count(*) FROM v_items)
  UNION ALL SELECT 'volume', greatest((SELECT CAST(ceil(count(*) * 0.5) AS BIGINT) FROM f_items0) - (SELECT count(*) FROM v_items), 0),
           (SELECT count(*) FROM v_items))""",
    f"v_items AS (SELECT *, CAST(creation_time_utc AS DATE) + CAST(CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 0 END AS INT) AS d FROM f_items"
    " WHERE order_id IS NOT NULL AND lineitem_id IS NOT NULL AND creation_time_utc IS NOT NULL AND item_price >= 0 AND item_quantity > 0)",
    items=RAW_ITEMS)


@register("dq_set_checks", SET_CHECKS_SQL)
def q_dq_set_checks(spark, sf_dir):
    """Checks over the valid lines of a defective load (some recorded a day late), against the whole load before it."""
    valid = split_valid(star.raw_order_items(spark, sf_dir))[0]
    late = F.when(F.col("l_suppkey") % 10 == 0, 1).otherwise(0)
    items = materialize(valid.select("order_id", "lineitem_id", F.date_add(F.to_date("creation_time_utc"), late).alias("order_date")), "checked")
    b = bronze(spark, sf_dir)
    return set_checks(items, b.order_item_options.select("order_id", "lineitem_id"), b.order_items.select("order_id"))


# --- E1: a profile that adds up --------------------------------------------------------------------------------------

PROFILED = ("app_name", "restaurant_id", "creation_time_utc", "order_id", "user_id", "is_loyalty", "lineitem_id", "item_category",
            "item_name", "item_price", "item_quantity")
WITHIN = 0.02   # fixed value: how far an estimate may be off


@register("profile_two_loads", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count,"
    f" true AS unique_within FROM f_items" for c in PROFILED)))
def q_profile_two_loads(spark, sf_dir):
    """The profile of two loads from their stored sketches; ``unique_within`` says whether it is within 2 % of exact counts."""
    items = materialize(bronze(spark, sf_dir).order_items.select(*PROFILED), "profiled")   # both loads and the exact counts read it
    root = scratch_folder(spark, "profiles")
    for load, part in (("2024/01/01", ~F.col("is_loyalty")), ("2024/01/02", F.col("is_loyalty"))):
        profile_sketches(items.filter(part)).write.parquet(f"{root}/{load}")
    merged = merged_profile(spark.read.option("recursiveFileLookup", "true").parquet(root))
    exact = M.checkpointed(_distinct_counts(items))
    near = F.abs(F.col("unique_values") - F.col("exact")) <= F.col("exact") * WITHIN
    return merged.join(exact, "column_name").select("column_name", "non_null_count", "null_count", near.alias("unique_within"))


def _distinct_counts(items):
    from ..operators.profile import column_profile
    return column_profile(items).select("column_name", F.col("unique_values").alias("exact"))


# --- IO9: stored results ---------------------------------------------------------------------------------------------

@register("cached_trends", with_ctes(
    "SELECT order_date, restaurant_id, item_category, " + dbl("daily_revenue") + ", " + big("daily_order_count") + " FROM trends"))
def q_cached_trends(spark, sf_dir):
    """A Gold table asked for twice: the second time from the stored result."""
    root = scratch_folder(spark, "results")
    cached(M.location_sales_trends(sales(spark, sf_dir)), root)
    return comparable(cached(M.location_sales_trends(sales(spark, sf_dir)), root))


# --- D1 in Gold ------------------------------------------------------------------------------------------------------

VIEW_BATCHES = 2   # fixed value: the feed's changes before and after the middle of its time


@register("location_trends_incremental", with_ctes(
    "SELECT i.order_date, i.restaurant_id, i.item_category,"
    " CAST(sum(m.item_price * m.item_quantity + coalesce(o.option_total, 0)) AS DOUBLE) AS daily_revenue,"
    " CAST(count(DISTINCT m.order_id) AS BIGINT) AS daily_order_count"
    " FROM cdc m JOIN c_items i ON m.order_id = i.order_id AND m.lineitem_id = i.lineitem_id"
    " LEFT JOIN c_opts o ON m.order_id = o.order_id AND m.lineitem_id = o.lineitem_id GROUP BY ALL", CDC_SQL))
def q_location_trends_incremental(spark, sf_dir):
    """``location_sales_trends`` made from the full load and kept current through the change feed."""
    b = bronze(spark, sf_dir)
    items = C.clean_order_items(b.order_items, b.dedup_order, b.drop_after_dedup)
    options = materialize(C.clean_order_item_options(b.order_item_options), "options")
    lines = materialize(change_base(items, *incremental.GROUP), "lines")
    changes = materialize(star.item_changes(spark, sf_dir), "changes")
    version = [c for c in changes.columns if c not in schemas.ITEM_KEYS]
    view = incremental.TrendView(scratch_folder(spark, "view"), grain="month")
    view.create(incremental.line_sales(lines, options))
    low, high = changes.agg(F.min("commit_ts"), F.max("commit_ts")).first()
    for batch in range(VIEW_BATCHES if low is not None else 0):
        early = F.col("commit_ts") < F.lit(low + (high - low) / VIEW_BATCHES)
        part = changes.filter(early if batch == 0 else ~early)
        before, others = incremental.divided(lines, part)
        after = materialize(incremental.next_lines(before, part, star.CHANGE_ORDER, version, named=True), "after")
        view.apply(incremental.signed_sales(before, after, options), batch)
        lines = materialize(others.unionByName(after), "lines")
    return comparable(view.read(spark))
