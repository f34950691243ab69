"""Join helpers that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000   # right rows of one key joined in one task


def hot_keys(right: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows and the number of salts each needs (at most one key per ``rows`` rows)."""
    counts = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    return counts.select(*keys, F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))


def left_join_fanout(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` where the many side is the right.

    Left rows with a null key match nothing and stay; they hash alike, and
    adaptive execution splits them like any hot key of the left side. It can
    split a LEFT OUTER join on that side only.
    ``hot`` (a written result of ``hot_keys``) names right keys that one task
    should not hold: their right rows are dealt over salts and their left rows
    copied to each. Such a key has right rows, so a copy that meets none in its
    salt is dropped.
    """
    keys = list(keys)
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    if hot is None:
        return left.join(right, keys, "left").select(*columns)
    dealt = right.join(hot, keys, "left").withColumn("_salt", F.coalesce(
        F.pmod(F.xxhash64(*right.columns), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts").withColumn("_met", F.lit(1))
    copied = left.join(hot, keys, "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return copied.join(dealt, [*keys, "_salt"], "left").filter("_salts is null or _met is not null").select(*columns)


def null_safe_lookup(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None) -> DataFrame:
    """Attach the columns of a one-row-per-key ``lookup`` with ``<=>`` on ``key``.

    Every key of ``df`` (including null) is present in ``lookup`` when the
    lookup was aggregated from ``df`` itself, so an inner join keeps all rows
    and lets AQE split a hot key on the big side, or broadcast the lookup
    when its measured size is below the broadcast threshold.
    """
    lk = lookup_key or f"_lk_{key}"
    lookup = lookup.withColumnRenamed(key, lk)
    joined = df.join(lookup, df[key].eqNullSafe(lookup[lk]), "inner")
    return joined.drop(lk)
