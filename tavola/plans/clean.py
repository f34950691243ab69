"""Bronze → Silver: cleaned order lines joined to their options (``sales_fact``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, order_date, parse_date_key, to_utc
from ..operators.dedup import dedup_by_key
from ..operators.joins import left_join_fanout
from ..schemas import ITEM_KEYS, MONEY
from ..sources.bronze import lower_case_columns

GUEST = "GUEST"   # fixed value: user_id given to orders without a customer


def dedup_order_items(items: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``(order_id, lineitem_id)``; the first by ``order_by`` survives."""
    return dedup_by_key(lower_case_columns(items), ITEM_KEYS, order_by)


def clean_order_items(items: DataFrame, order_by: Sequence[str] | None = None,
                      drop: Sequence[str] = ()) -> DataFrame:
    """Dedup, guest fill, price cast, timestamp parse, order date and line total."""
    items = dedup_order_items(items, order_by)
    if drop:
        items = items.drop(*drop)
    ts_type = items.schema["creation_time_utc"].dataType
    return (items
            .withColumn("user_id", F.coalesce(F.col("user_id"), F.lit(GUEST)))
            .withColumn("item_price", F.col("item_price").try_cast(MONEY))
            .withColumn("item_quantity", F.col("item_quantity").try_cast("int"))
            .withColumn("creation_time_utc", as_timestamp("creation_time_utc", ts_type))
            .withColumn("order_date", order_date("creation_time_utc"))
            .withColumn("item_total", F.col("item_price") * F.col("item_quantity")))


def clean_order_item_options(options: DataFrame, dedup: bool = False) -> DataFrame:
    """Lower-case names, price cast and option total.

    Options are not deduplicated by default, as in the source pipeline;
    ``dedup=True`` drops exact duplicate rows.
    """
    options = lower_case_columns(options)
    if dedup:
        options = options.dropDuplicates()
    return (options
            .withColumn("option_price", F.col("option_price").try_cast(MONEY))
            .withColumn("option_quantity", F.col("option_quantity").try_cast("int"))
            .withColumn("option_total", F.col("option_price") * F.col("option_quantity")))


def sales_fact(items: DataFrame, options: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Items left-joined to options: one row per item × option.

    An item's total repeats once per option (the fan-out is kept as in the
    source pipeline; see ``metrics.order_summary_exact``). Missing option
    totals and prices become 0, and the line revenue is item + option total.
    ``hot`` names lines with very many options (``joins.hot_keys``).
    """
    joined = left_join_fanout(items, options, ITEM_KEYS, hot)
    return (joined
            .withColumn("option_total", F.coalesce(F.col("option_total"), F.lit(0).cast(MONEY)))
            .withColumn("option_price", F.coalesce(F.col("option_price"), F.lit(0).cast(MONEY)))
            .withColumn("total_line_item_revenue", F.col("item_total") + F.col("option_total")))


def clean_date_dim(date_dim: DataFrame) -> DataFrame:
    """Parse ``date_key`` from ``dd-MM-yyyy``; other layouts give null."""
    return lower_case_columns(date_dim).withColumn("date_key", parse_date_key("date_key"))


def to_utc_times(items: DataFrame, source_tz: str) -> DataFrame:
    """Order lines whose wall-clock times were recorded in ``source_tz``, in UTC."""
    kind = items.schema["creation_time_utc"].dataType
    return items.withColumn("creation_time_utc", to_utc(as_timestamp("creation_time_utc", kind), source_tz))


def clean(bronze, dedup_options: bool = False, hot: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver ``sales_fact`` and ``date_dim`` from a ``Bronze`` bundle.

    ``dedup_options=True`` drops exact duplicate option rows before the join
    (the source pipeline keeps them, doubling those options' revenue).
    """
    items = clean_order_items(bronze.order_items, bronze.dedup_order, bronze.drop_after_dedup)
    options = clean_order_item_options(bronze.order_item_options, dedup=dedup_options)
    return sales_fact(items, options, hot), clean_date_dim(bronze.date_dim)
