"""Exploration of the raw Bronze tables: profiles, subtotals, free items and option sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.profile import column_profile, non_null_counts
from ..sources import star
from .oracle_sql import COMPED
from .registry import comparable, register, with_ctes


def order_subtotals(items: DataFrame) -> DataFrame:
    """Raw price × quantity summed per order (no options, no dedup); all-null sums are 0."""
    return (items.groupBy("order_id")
            .agg(F.coalesce(F.sum(F.col("item_price") * F.col("item_quantity")), F.lit(0)).alias("subtotal")))


def latest_orders(items: DataFrame, n: int = 10) -> DataFrame:
    return (items.select("creation_time_utc")
            .orderBy(F.col("creation_time_utc").desc_nulls_last()).limit(n))


def free_items(items: DataFrame) -> DataFrame:
    return items.filter(F.col("item_price") == 0).select("item_name")


def free_option_names(options: DataFrame) -> DataFrame:
    return options.filter(F.col("option_price") == 0).select("option_name").distinct()


def paid_option_names(options: DataFrame) -> DataFrame:
    return options.filter(F.col("option_price") > 0).select("option_name").distinct()


def options_sometimes_free(options: DataFrame) -> DataFrame:
    """Names seen both free and paid (INTERSECT; null names compare equal)."""
    return free_option_names(options).intersect(paid_option_names(options))


def options_always_free(options: DataFrame) -> DataFrame:
    """Names only ever free (EXCEPT DISTINCT)."""
    return free_option_names(options).subtract(paid_option_names(options))


def option_price_sets(options: DataFrame) -> DataFrame:
    """Sizes of the free, paid, overlapping and always-free name sets, in one pass per name."""
    per_name = (options.groupBy("option_name")
                .agg(F.max(F.col("option_price") == 0).alias("free"), F.max(F.col("option_price") > 0).alias("paid")))
    free, paid = F.coalesce(F.col("free"), F.lit(False)), F.coalesce(F.col("paid"), F.lit(False))
    return per_name.agg(F.count_if(free).alias("free_names"), F.count_if(paid).alias("paid_names"),
                        F.count_if(free & paid).alias("overlap_names"),
                        F.count_if(free & ~paid).alias("always_free_names"))


def user_membership_counts(items: DataFrame) -> DataFrame:
    """Rows whose user_id is among the table's own user ids (null-safe), counted per column."""
    users = items.select(F.col("user_id").alias("_u")).distinct()
    kept = items.join(users, items["user_id"].eqNullSafe(users["_u"]), "left_semi")
    return non_null_counts(kept)


# === registered queries ===============================================================

def _raw_items(spark, sf_dir):
    return star.order_items(spark, sf_dir).drop(*star.TIEBREAK_COLUMNS)


ITEM_TYPES = (("app_name", "string"), ("restaurant_id", "string"), ("creation_time_utc", "timestamp"),
              ("order_id", "string"), ("user_id", "string"), ("printed_card_number", "string"),
              ("is_loyalty", "boolean"), ("currency", "string"), ("lineitem_id", "string"),
              ("item_category", "string"), ("item_name", "string"), ("item_price", "decimal(12,2)"),
              ("item_quantity", "int"))
OPTION_TYPES = (("order_id", "string"), ("lineitem_id", "string"), ("option_group_name", "string"),
                ("option_name", "string"), ("option_price", "decimal(12,2)"), ("option_quantity", "int"))
DATE_TYPES = (("date_key", "string"), ("day_of_week", "string"), ("week", "int"), ("month", "string"),
              ("year", "int"), ("is_weekend", "boolean"), ("is_holiday", "boolean"), ("holiday_name", "string"))

RAW_ITEMS = "raw_items AS (SELECT * EXCLUDE (l_partkey, l_suppkey, l_extendedprice, l_shipdate) FROM f_items)"


def _profile_sql(table: str, cols) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null_count, "
        f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, '{t}' AS data_type, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_values, "
        f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table})) AS BIGINT) AS duplicates "
        f"FROM {table}" for c, t in cols]
    return with_ctes(" UNION ALL ".join(parts), RAW_ITEMS)


@register("profile_order_items", _profile_sql("raw_items", ITEM_TYPES))
def q_profile_order_items(spark, sf_dir):
    return column_profile(_raw_items(spark, sf_dir))


@register("profile_options", _profile_sql("f_opts", OPTION_TYPES))
def q_profile_options(spark, sf_dir):
    return column_profile(star.order_item_options(spark, sf_dir))


@register("profile_date_dim", _profile_sql("raw_dates", DATE_TYPES))
def q_profile_date_dim(spark, sf_dir):
    return column_profile(star.date_dim(spark, sf_dir))


@register("order_subtotals", with_ctes(
    "SELECT order_id, CAST(coalesce(sum(item_price * item_quantity), 0) AS DOUBLE) AS subtotal "
    "FROM raw_items GROUP BY order_id", RAW_ITEMS))
def q_order_subtotals(spark, sf_dir):
    return comparable(order_subtotals(_raw_items(spark, sf_dir)))


@register("latest_orders", with_ctes(
    "SELECT creation_time_utc FROM raw_items ORDER BY creation_time_utc DESC NULLS LAST LIMIT 10", RAW_ITEMS))
def q_latest_orders(spark, sf_dir):
    return latest_orders(_raw_items(spark, sf_dir))


@register("free_items", with_ctes("SELECT item_name FROM raw_items WHERE item_price = 0", RAW_ITEMS))
def q_free_items(spark, sf_dir):
    return free_items(_raw_items(spark, sf_dir))


@register("options_sometimes_free", with_ctes(
    "SELECT option_name FROM f_opts WHERE option_price = 0 INTERSECT SELECT option_name FROM f_opts "
    "WHERE option_price > 0"))
def q_options_sometimes_free(spark, sf_dir):
    return options_sometimes_free(star.order_item_options(spark, sf_dir))


@register("options_always_free", with_ctes(
    "SELECT option_name FROM f_opts WHERE option_price = 0 EXCEPT SELECT option_name FROM f_opts "
    "WHERE option_price > 0", options=COMPED))
def q_options_always_free(spark, sf_dir):
    return options_always_free(star.comped_options(spark, sf_dir))


@register("option_price_sets", with_ctes(
    "SELECT CAST((SELECT count(*) FROM (SELECT DISTINCT option_name FROM f_opts WHERE option_price = 0)) AS BIGINT)"
    " AS free_names,"
    " CAST((SELECT count(*) FROM (SELECT DISTINCT option_name FROM f_opts WHERE option_price > 0)) AS BIGINT)"
    " AS paid_names,"
    " CAST((SELECT count(*) FROM (SELECT option_name FROM f_opts WHERE option_price = 0 INTERSECT"
    " SELECT option_name FROM f_opts WHERE option_price > 0)) AS BIGINT) AS overlap_names,"
    " CAST((SELECT count(*) FROM (SELECT option_name FROM f_opts WHERE option_price = 0 EXCEPT"
    " SELECT option_name FROM f_opts WHERE option_price > 0)) AS BIGINT) AS always_free_names", options=COMPED))
def q_option_price_sets(spark, sf_dir):
    return option_price_sets(star.comped_options(spark, sf_dir))


@register("user_membership_counts", with_ctes(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null_count FROM kept" for c, _ in ITEM_TYPES),
    RAW_ITEMS,
    "kept AS (SELECT * FROM raw_items i WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT user_id FROM raw_items) u"
    " WHERE u.user_id IS NOT DISTINCT FROM i.user_id))"))
def q_user_membership_counts(spark, sf_dir):
    return user_membership_counts(_raw_items(spark, sf_dir))


@register("free_option_names", with_ctes("SELECT DISTINCT option_name FROM f_opts WHERE option_price = 0"))
def q_free_option_names(spark, sf_dir):
    return free_option_names(star.order_item_options(spark, sf_dir))


@register("paid_option_names", with_ctes("SELECT DISTINCT option_name FROM f_opts WHERE option_price > 0"))
def q_paid_option_names(spark, sf_dir):
    return paid_option_names(star.order_item_options(spark, sf_dir))
