"""Gold kept current from the change feed: ``location_sales_trends`` maintained from signed line changes.

A changed order line is a pair: its old sales rows go out (-1), its new ones
come in (+1). Summed per day, restaurant, category and order, the pairs that
change nothing cancel, and what is left names the partitions to merge; the
others are neither read nor written. Distinct orders do not add up, so the
view keeps how many sales rows each order has in a group: an order counts
while that number is above zero.

Each written partition carries the number of the last batch merged into it,
so that a batch applied again after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import DELETE
from ..operators.materialize import materialize
from ..schemas import ITEM_KEYS
from ..sources import sinks
from . import clean as C

GROUP = ("order_date", "restaurant_id", "item_category")
BATCH = "tavola_batch"


# --- lines ---------------------------------------------------------------------------------------------------------

def next_lines(lines: DataFrame, changes: DataFrame, order: Sequence[str], version: Sequence[str], named: bool = False) -> DataFrame:
    """The changed keys' lines after a batch, deletes as tombstones (op ``D``), from the lines before and the changes.

    ``version`` columns come from the latest row per key by ``order`` (nulls
    first), the others of ``lines`` from the line itself. One map-side combined
    aggregation, so a key with very many changes costs a row per task.
    ``named``: the lines are those that the changes name (``divided``).
    """
    latest = F.max_by(F.struct(*version), F.struct(*order)).alias("_v")
    rest = [c for c in lines.columns if c not in ITEM_KEYS and c not in version]
    both = (lines if named else touched(lines, changes)).unionByName(changes, allowMissingColumns=True)
    merged = both.groupBy(*ITEM_KEYS).agg(latest, *[F.max(c).alias(c) for c in rest])
    return merged.select(*[F.col("_v")[c].alias(c) if c in version else F.col(c) for c in lines.columns])


def feed_merge(order: Sequence[str], version: Sequence[str]):
    """A merge for ``ingest.start_ingest`` that keeps the columns the feed lacks."""
    def merge(state: DataFrame, changes: DataFrame) -> DataFrame:
        return untouched(state, changes).unionByName(next_lines(state, changes, order, version))
    return merge


def feed_refresh(view: TrendView, options: DataFrame):
    """Keeps the view current with the stream: for ``ingest.start_ingest``'s ``on_merged``."""
    def refresh(before: DataFrame, after: DataFrame, changes: DataFrame, batch: int) -> None:
        view.apply(signed_sales(touched(before, changes), touched(after, changes), options), batch)
    return refresh


def touched(lines: DataFrame, changes: DataFrame) -> DataFrame:
    """The lines whose key the changes name."""
    return lines.join(changes.select(*ITEM_KEYS).distinct(), list(ITEM_KEYS), "left_semi")


def untouched(lines: DataFrame, changes: DataFrame) -> DataFrame:
    return lines.join(changes.select(*ITEM_KEYS).distinct(), list(ITEM_KEYS), "left_anti")


def divided(lines: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``touched`` and ``untouched`` from one join, written once."""
    keys = changes.select(*ITEM_KEYS).distinct().withColumn("_touched", F.lit(True))
    both = materialize(lines.join(keys, list(ITEM_KEYS), "left").select(*lines.columns, "_touched"), "divided")
    return both.filter("_touched").drop("_touched"), both.filter("_touched is null").drop("_touched")


def line_sales(lines: DataFrame, options: DataFrame) -> DataFrame:
    """Sales rows of lines that are not deleted (item × option, as in Silver)."""
    alive = lines.filter(F.col("op").isNull() | (F.col("op") != DELETE))
    return C.sales_fact(alive.withColumn("item_total", F.col("item_price") * F.col("item_quantity")), options)


def signed_sales(before: DataFrame, after: DataFrame, options: DataFrame) -> DataFrame:
    """Old sales rows of changed lines with -1, new ones with +1."""
    lines = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)), allowMissingColumns=True)
    return line_sales(lines, options)   # the options are joined once


# --- the view ------------------------------------------------------------------------------------------------------

def _order_facts(signed: DataFrame) -> DataFrame:
    """Per group and order: sales rows, those with a revenue, and their revenue, signed."""
    revenue = F.col("total_line_item_revenue")
    return signed.groupBy(*GROUP, "order_id").agg(
        F.sum("sign").alias("rows"), F.sum(F.when(revenue.isNotNull(), F.col("sign")).otherwise(0)).alias("valued"),
        F.sum(F.coalesce(revenue, F.lit(0)) * F.col("sign")).cast("decimal(38,2)").alias("revenue"))


@dataclass(frozen=True)
class TrendView:
    """``orders`` (rows and revenue per group and order) and ``trends`` (the Gold table) under ``root``, both partitioned by
    order date or, with ``grain``, by the period it lies in."""

    root: str
    grain: str | None = None

    @property
    def part(self) -> str:
        return sinks.partition_column("order_date", self.grain)

    def _parted(self, df: DataFrame) -> DataFrame:
        return df if self.grain is None else df.withColumn(self.part, F.trunc("order_date", self.grain))

    def create(self, sales: DataFrame) -> None:
        """The view over all of Silver, batch -1."""
        facts = self._parted(_order_facts(sales.withColumn("sign", F.lit(1)))).withColumn(BATCH, F.lit(-1).cast("long"))
        _write(facts, f"{self.root}/orders", self.part)
        _write(_trends(sales.sparkSession.read.parquet(f"{self.root}/orders"), self.part), f"{self.root}/trends", self.part)

    def apply(self, signed: DataFrame, batch: int) -> list:
        """Merge one batch of signed sales rows; the partitions merged now (none if the batch was applied before).

        Batches must be applied in ascending order of their number.
        """
        spark = signed.sparkSession
        facts = materialize(self._parted(_order_facts(signed).filter("rows <> 0 or valued <> 0 or revenue <> 0")), "view-changes")
        parts = _values(facts, self.part)
        if not parts:
            return []
        held = self.read_orders(spark, parts)
        merged_before = _values(held.filter(F.col(BATCH) >= batch), self.part)
        todo = [p for p in parts if p not in merged_before]
        if todo:
            new = facts.filter(_among(self.part, todo)).withColumn("_new", F.lit(True))
            old = held.filter(_among(self.part, todo)).drop(BATCH)
            summed = (old.unionByName(new, allowMissingColumns=True).groupBy(*dict.fromkeys([self.part, *GROUP]), "order_id")
                      .agg(F.sum("rows").alias("rows"), F.sum("valued").alias("valued"), F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
                      .filter("rows > 0"))
            # A partition that lost its last row is written as well: a row without sales stands for it.
            marks = new.select(self.part).distinct().withColumn("rows", F.lit(0).cast("long"))
            _write(summed.unionByName(marks, allowMissingColumns=True).withColumn(BATCH, F.lit(batch).cast("long")),
                   f"{self.root}/orders", self.part, dynamic=True)
        # Also for partitions merged before: a run may have failed between the two tables.
        _write(_trends(self.read_orders(spark, parts), self.part), f"{self.root}/trends", self.part, dynamic=True)
        return todo

    def read_orders(self, spark: SparkSession, parts: list | None = None) -> DataFrame:
        """Rows per group and order, of the given partitions only (pruned by folder)."""
        df = spark.read.parquet(f"{self.root}/orders")
        return df if parts is None else df.filter(_among(self.part, parts))

    def read(self, spark: SparkSession) -> DataFrame:
        """The maintained ``location_sales_trends``."""
        df = spark.read.parquet(f"{self.root}/trends").filter("rows > 0")
        return df.select(*GROUP, "daily_revenue", "daily_order_count")


def _trends(orders: DataFrame, part: str) -> DataFrame:
    """Gold rows from rows per order; a partition without sales keeps one row with 0 ``rows``."""
    return (orders.groupBy(*dict.fromkeys([part, *GROUP]))
            .agg(F.when(F.sum("valued") > 0, F.sum("revenue")).alias("daily_revenue"),
                 F.count_if(F.col("order_id").isNotNull() & (F.col("rows") > 0)).alias("daily_order_count"), F.sum("rows").alias("rows")))


def _write(df: DataFrame, path: str, part: str, dynamic: bool = False) -> None:
    sinks.write_partitioned(df, path, part, dynamic=dynamic)


def _values(df: DataFrame, column: str) -> list:
    """Different values of a partition column: at most one per calendar day."""
    return [r[0] for r in df.select(column).distinct().collect()]


def _among(column: str, values: list) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known
