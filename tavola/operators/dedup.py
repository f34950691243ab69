"""Key deduplication with a fixed tie-break."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``; null keys form groups.

    A filter on ``row_number() = 1``: Spark keeps one row per key in every map
    task before the shuffle (``WindowGroupLimit``), so a key with many rows
    costs one row per task, and columns nobody reads are pruned below it.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(w)).filter("_row = 1").drop("_row")


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (ascending, nulls first).

    ``order_by`` defaults to every non-key column, so the surviving row does
    not depend on input order.
    """
    keys = list(keys)
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(keys)
    return first_by_key(df, keys, [F.col(c).asc_nulls_first() for c in order])
