"""Ordered scans without a single-task window.

A window with no PARTITION BY (global NTILE) runs in one task, and a window
partitioned by a customer runs a hot customer in one task. Here Spark's own
range partitioner deals the rows into contiguous *ranges* of the full sort
order (a composite key that ends in a unique column, so a hot leading value
still spreads over many ranges), and the dealt rows are written with the
number of their range. What crosses a range boundary lies in a *directory*:
a table with one row per range (about one for ``rows_per_part`` rows) over
which Spark takes running totals, and which is joined back by the range.
Neither the driver nor the plan holds anything per range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.buckets import ntile_from_position
from .materialize import materialize

PART, PLACE = "_part", "_place"
ROW_BITS = 33   # fixed value: monotonically_increasing_id() holds the task above the row's place in it
SAMPLE_SIZE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


@dataclass(frozen=True)
class Key:
    """One sort column: direction and null placement as in SQL ORDER BY."""

    name: str
    ascending: bool = True
    nulls_first: bool | None = None  # None: Spark's default (first for ASC, last for DESC)

    @property
    def nf(self) -> bool:
        return self.ascending if self.nulls_first is None else self.nulls_first

    def sort_expr(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_first() if self.nf else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nf else c.desc_nulls_last()


def keys_of(spec: Sequence[Key | str]) -> list[Key]:
    return [k if isinstance(k, Key) else Key(k) for k in spec]


@dataclass(frozen=True)
class RangeConfig:
    """How finely to cut the order: about ``rows_per_part`` rows per range and
    at least ``min_parts`` ranges; Spark chooses their bounds from about
    ``sample_per_part`` keys per range. The number of ranges grows with the rows."""

    rows_per_part: int = 2_000_000
    min_parts: int = 8
    sample_per_part: int = 64

    def parts_for(self, n: int) -> int:
        return max(self.min_parts, math.ceil(n / self.rows_per_part))


def _order(spec: list[Key]) -> list[Column]:
    return [k.sort_expr() for k in spec]


@contextmanager
def _sampling(df: DataFrame, cfg: RangeConfig):
    """Size of the range partitioner's sample while a dealt frame is written."""
    conf = df.sparkSession.conf
    before = conf.get(SAMPLE_SIZE)
    conf.set(SAMPLE_SIZE, str(cfg.sample_per_part))
    try:
        yield
    finally:
        conf.set(SAMPLE_SIZE, before)


def with_range(df: DataFrame, spec: Sequence[Key | str], cfg: RangeConfig = RangeConfig(),
               n: int | None = None) -> tuple[DataFrame, int, int]:
    """Add ``_part``: index of the contiguous range of the sort order holding the row.

    Returns the frame, the number of ranges asked for and the row count. The
    bounds are chosen when the frame is executed and hold for that execution,
    lost tasks included: use the result once, or write it first.
    """
    spec = keys_of(spec)
    n = df.count() if n is None else n
    parts = cfg.parts_for(n)
    return df.repartitionByRange(parts, *_order(spec)).withColumn(PART, F.spark_partition_id()), parts, n


def ranked(df: DataFrame, spec: Sequence[Key | str], cfg: RangeConfig = RangeConfig(), n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` dealt by the order of ``spec`` and written with ``_part`` and ``_place`` (from 0, within the range), and its
    directory: per range ``_part``, ``_before`` (rows of all earlier ranges) and ``_total`` (rows of all).

    A row's place in the whole order is ``_before + _place``. One shuffle.
    """
    spec = keys_of(spec)
    n = df.count() if n is None else n
    at = F.monotonically_increasing_id()
    with _sampling(df, cfg):
        dealt = materialize(df.repartitionByRange(cfg.parts_for(n), *_order(spec)).sortWithinPartitions(*_order(spec))
                            .withColumn(PLACE, at), "ranked")
    dealt = dealt.withColumn(PART, F.shiftright(PLACE, ROW_BITS).cast("int")) \
        .withColumn(PLACE, F.col(PLACE).bitwiseAND((1 << ROW_BITS) - 1))
    return dealt, directory(dealt)


def directory(dealt: DataFrame) -> DataFrame:
    """Rows before each range and in all, one written row per range."""
    every = Window.orderBy(PART)   # over one row per range
    counts = dealt.groupBy(PART).agg(F.count(F.lit(1)).alias("_rows"))
    return materialize(counts.select(
        PART, (F.sum("_rows").over(every.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy()).alias("_total")), "directory")


def multi_ntile(df: DataFrame, specs: dict[str, Sequence[Key | str]], k: int,
                cfg: RangeConfig = RangeConfig(), n: int | None = None) -> DataFrame:
    """Several ``NTILE(k) OVER (ORDER BY spec)`` columns (``out: spec``).

    Each output column is one range shuffle of the rows and one join with the
    directory of its ranges. ``df`` should be materialized (it is read for the
    count, a key sample and the first shuffle).
    """
    n = df.count() if n is None else n
    if n == 0:
        return df.select("*", *[F.lit(None).cast(T.LongType()).alias(out) for out in specs])
    for out, spec in specs.items():
        dealt, ranges = ranked(df, spec, cfg, n)
        bucket = ntile_from_position(F.col("_before") + F.col(PLACE) + 1, F.col("_total"), k)
        df = dealt.join(ranges, PART).withColumn(out, bucket).drop(PART, PLACE, "_before", "_total")
    return df


def grouped_scan(df: DataFrame, group: str, order: Sequence[Key | str], *,
                 lags: dict[str, str] | None = None, running: dict[str, str] | None = None,
                 cfg: RangeConfig = RangeConfig()) -> DataFrame:
    """Per-group ``lag`` and running ``sum`` over ``ORDER BY order``, skew-safe.

    Equivalent to ``lag(c) OVER (PARTITION BY group ORDER BY order)`` for each
    ``out: c`` in ``lags`` and ``sum(c) OVER (PARTITION BY group ORDER BY order
    ROWS UNBOUNDED PRECEDING)`` for each ``out: c`` in ``running``. ``group``
    must not be null and ``order`` must make rows unique within a group.
    Windows run per range; what a range needs from the ones before it is
    carried by ``_carries``.
    """
    lags, running = dict(lags or {}), dict(running or {})
    spec = [Key(group)] + keys_of(order)
    parted, _, _ = with_range(df, spec, cfg)
    w = Window.partitionBy(PART).orderBy(*_order(spec))
    wg = Window.partitionBy(PART, group).orderBy(*_order(spec)).rowsBetween(Window.unboundedPreceding, 0)
    scanned = parted.withColumn("_rn", F.row_number().over(w)).withColumn("_pg", F.lag(group).over(w))
    for out, c in lags.items():
        scanned = scanned.withColumn(out, F.lag(c).over(w))
    for out, c in running.items():
        scanned = scanned.withColumn(out, F.sum(c).over(wg))
    # The windows feed both the boundary facts and the output, and the ranges hold for one execution: written once.
    with _sampling(df, cfg):
        scanned = materialize(scanned, "scan")
    fixed = scanned.join(_carries(scanned, group, lags, running), PART)
    same_prev = F.coalesce(F.col("_cg") == F.col(group), F.lit(False))
    for out in lags:
        first = F.col("_rn") == 1
        fixed = fixed.withColumn(out, F.when(first, F.when(same_prev, F.col(f"_cl_{out}")))
                                 .otherwise(F.when(F.col("_pg") == F.col(group), F.col(out))))
    for out in running:
        carried = F.col(f"_cr_{out}")
        fixed = fixed.withColumn(out, F.when(same_prev & carried.isNotNull(), F.coalesce(F.col(out), F.lit(0)) + carried)
                                 .otherwise(F.col(out)).cast(scanned.schema[out].dataType))
    drop = [PART, "_rn", "_pg", "_cg"] + [f"_cl_{o}" for o in lags] + [f"_cr_{o}" for o in running]
    return fixed.drop(*drop)


def _carries(scanned: DataFrame, group: str, lags: dict[str, str], running: dict[str, str]) -> DataFrame:
    """What each range takes over from the ranges before it, one written row per range: the group of the row before it
    (``_cg``), that row's values (``_cl_…``) and the group's running totals up to it (``_cr_…``).

    The totals are a segmented prefix sum over the ranges: a range that lies
    within one group and goes on with the group of the range before adds to
    that one's segment; any other range starts a new segment, with the total
    its last group has there.
    """
    last = F.struct(group, *[F.col(c).alias(f"_cl_{out}") for out, c in lags.items()],
                    *[F.col(out).alias(f"_cr_{out}") for out in running])
    ends = scanned.groupBy(PART).agg(F.min_by(group, "_rn").alias("_first"), F.max_by(last, F.col("_rn")).alias("_last"))
    every = Window.orderBy(PART)   # over one row per range
    before = F.lag(F.col("_last")[group]).over(every)
    starts = F.coalesce((F.col("_first") != F.col("_last")[group]) | (F.col("_first") != before), F.lit(True))
    ends = ends.withColumn("_starts", starts.cast("int")) \
        .withColumn("_segment", F.sum("_starts").over(every.rowsBetween(Window.unboundedPreceding, 0)))
    so_far = Window.partitionBy("_segment").orderBy(PART).rowsBetween(Window.unboundedPreceding, 0)
    totals = ends.select(PART, F.col("_last")[group].alias("_g"), *[F.col("_last")[f"_cl_{out}"].alias(f"_l_{out}") for out in lags],
                         *[F.sum(F.col("_last")[f"_cr_{out}"]).over(so_far).alias(f"_t_{out}") for out in running])
    return materialize(totals.select(
        PART, F.lag("_g").over(every).alias("_cg"), *[F.lag(f"_l_{out}").over(every).alias(f"_cl_{out}") for out in lags],
        *[F.lag(f"_t_{out}").over(every).alias(f"_cr_{out}") for out in running]), "carries")
