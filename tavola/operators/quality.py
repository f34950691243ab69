"""Ingestion validation and row-level data-quality rules with quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rule names of order-line checks, in the order they are applied.
ITEM_RULES = ("missing_key", "missing_timestamp", "bad_price", "bad_quantity")


def item_rule_columns() -> list[tuple[str, Column]]:
    return [
        ("missing_key", F.col("order_id").isNull() | F.col("lineitem_id").isNull()),
        ("missing_timestamp", F.col("creation_time_utc").isNull()),
        ("bad_price", F.col("item_price").isNull() | (F.col("item_price") < 0)),
        ("bad_quantity", F.col("item_quantity").isNull() | (F.col("item_quantity") <= 0)),
    ]


def with_reject_reason(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None) -> DataFrame:
    """Add ``reject_reason``: the first failing rule, or null for a valid row."""
    rules = list(rules or item_rule_columns())
    reason = F.lit(None).cast(T.StringType())
    for name, failed in reversed(rules):
        reason = F.when(F.coalesce(failed, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def split_valid(df: DataFrame, rules=None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``) — the second is the quarantine."""
    tagged = with_reject_reason(df, rules)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


def dq_report(df: DataFrame, rules=None) -> DataFrame:
    """Rows per outcome: ``valid`` or the rule that rejected them."""
    tagged = with_reject_reason(df, rules)
    return (tagged.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("rows")))


def validate_table(df: DataFrame, table: str, keys: Sequence[str], date_col: Column | None = None,
                   expected: T.StructType | None = None) -> DataFrame:
    """One row of ingestion checks: rows, rows with a null key, date range, missing columns."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    d = date_col if date_col is not None else F.lit(None).cast(T.DateType())
    missing = [f.name for f in (expected.fields if expected else []) if f.name not in df.columns]
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(null_key).alias("null_key_rows"),
                  F.min(d).alias("min_date"), F.max(d).alias("max_date")).select(
        F.lit(table).alias("table_name"), "row_count", "null_key_rows", "min_date", "max_date",
        F.lit(",".join(missing)).alias("missing_columns"))


# --- checks over sets of rows ----------------------------------------------------------------------------------------

def orphan_rows(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose key no row of ``parent`` has; a null key has no parent."""
    return child.join(parent.select(*keys).distinct(), list(keys), "left_anti")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with the rows beyond the first as ``extra``; null keys are equal."""
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return counts.filter("extra > 0")


def conflicting_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one different value of a column (nulls apart)."""
    spread = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    return spread.filter("low <> high")


def set_checks(items: DataFrame, options: DataFrame, previous: DataFrame, keys: Sequence[str] = ("order_id", "lineitem_id"),
               date: str = "order_date", least_share: float = 0.5) -> DataFrame:
    """One row per check: ``check_name``, ``failures``, ``rows`` (checked) and ``passed``.

    Options without a line, lines beyond the first of their key, orders on two
    dates, and volume: lines missing to ``least_share`` of the previous load's.
    """
    def counted(name: str, failed: DataFrame, amount=None) -> DataFrame:
        n = F.count(F.lit(1)) if amount is None else F.coalesce(F.sum(amount), F.lit(0))
        return failed.agg(n.cast("long").alias("failures")).withColumn("check_name", F.lit(name))

    both = items.select(F.lit(1).alias("now"), F.lit(0).alias("then")).unionByName(previous.select(F.lit(0).alias("now"), F.lit(1).alias("then")))
    volume = both.agg(F.coalesce(F.sum("now"), F.lit(0)).alias("rows"),
                      F.ceil(F.coalesce(F.sum("then"), F.lit(0)) * F.lit(least_share)).cast("long").alias("wanted"))
    checks = [counted("options_without_line", orphan_rows(options, items, keys)),
              counted("repeated_lines", repeated_keys(items, keys), F.col("extra")),
              counted("orders_on_two_dates", conflicting_values(items, "order_id", date)),
              volume.select(F.greatest(F.col("wanted") - F.col("rows"), F.lit(0)).alias("failures"), F.lit("volume").alias("check_name"))]
    found = checks[0]
    for c in checks[1:]:
        found = found.unionByName(c)
    sizes = items.agg(F.count(F.lit(1)).alias("rows")).withColumn("of", F.lit("items")).unionByName(options.agg(F.count(F.lit(1)).alias("rows")).withColumn("of", F.lit("options")))
    of = F.when(F.col("check_name") == "options_without_line", "options").otherwise("items")
    return found.withColumn("of", of).join(sizes, "of").select("check_name", "failures", "rows", (F.col("failures") == 0).alias("passed"))


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """``df`` that gathers the measures (aggregates) while it is written or otherwise run through, without a scan of its
    own; ``get`` of the observation waits for that run."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(n) for n, c in measures.items()]), seen
