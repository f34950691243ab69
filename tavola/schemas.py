"""Declared schemas of the Bronze, Silver and Gold tables.

Bronze is read with these schemas (never inferred) after column names are
lower-cased; Silver and Gold schemas document what the plans produce.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

ORDER_ITEMS = T.StructType([
    T.StructField("app_name", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("creation_time_utc", T.TimestampType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("printed_card_number", T.StringType()),
    T.StructField("is_loyalty", T.BooleanType()),
    T.StructField("currency", T.StringType()),
    T.StructField("lineitem_id", T.StringType()),
    T.StructField("item_category", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("item_price", MONEY),
    T.StructField("item_quantity", T.IntegerType()),
])

ORDER_ITEM_OPTIONS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("lineitem_id", T.StringType()),
    T.StructField("option_group_name", T.StringType()),
    T.StructField("option_name", T.StringType()),
    T.StructField("option_price", MONEY),
    T.StructField("option_quantity", T.IntegerType()),
])

DATE_DIM = T.StructType([
    T.StructField("date_key", T.StringType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_holiday", T.BooleanType()),
    T.StructField("holiday_name", T.StringType()),
])

# Raw text layout (CSV exports): every column arrives as a string and is cast
# by the cleaning step, so bad values become nulls instead of failing the read.
def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


ITEM_KEYS = ("order_id", "lineitem_id")

GOLD_TABLES = (
    "customer_intelligence",
    "customer_rolling_metrics",
    "location_sales_trends",
    "loyalty_roi_analysis",
    "discount_effectiveness",
)
