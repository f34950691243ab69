"""Column profile of a table: non-null, null and distinct counts, type, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row per column: ``column_name, non_null_count, null_count, data_type,
    unique_values, duplicates``.

    ``unique_values`` excludes nulls; ``duplicates`` (same on every row) counts
    rows equal to an earlier row over all columns, nulls equal. Exact counts
    group narrow (column, value) pairs, and whole rows once, both combined
    before the shuffle; ``approx=True`` takes HyperLogLog sketches in a single
    pass instead.
    """
    if not approx:
        return _exact_profile(df)
    aggs = [F.count(F.lit(1)).alias("_rows"), F.approx_count_distinct(F.struct(*df.columns), rsd).alias("_distinct_rows")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(F.col(c)).alias(f"_nn{i}"), F.approx_count_distinct(F.col(c), rsd).alias(f"_nd{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                              F.col(f"_nn{i}").alias("non_null_count"),
                              (F.col("_rows") - F.col(f"_nn{i}")).alias("null_count"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col(f"_nd{i}").cast("long").alias("unique_values"),
                              (F.col("_rows") - F.col("_distinct_rows")).cast("long").alias("duplicates"))
                     for i, f in enumerate(df.schema.fields)])
    return one.select(F.inline(rows))


def _text(name: str, kind: T.DataType) -> Column:
    """A value as text: equal values give equal text, unlike values unlike text."""
    c = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (c + F.lit(0.0)).cast("string")   # -0.0 equals 0.0
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType))
    return F.when(c.isNotNull(), F.to_json(F.struct(c))) if nested else c.cast("string")


def _pairs(df: DataFrame) -> DataFrame:
    """(column number, value as text) of every value, nulls left out."""
    made = F.array(*[F.struct(F.lit(i).alias("i"), _text(f.name, f.dataType).alias("value")) for i, f in enumerate(df.schema.fields)])
    return df.select(F.inline(made)).filter("value is not null")


def _named(df: DataFrame) -> DataFrame:
    """One row per column: its number, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "i int, column_name string, data_type string")


def _exact_profile(df: DataFrame) -> DataFrame:
    values = _pairs(df).groupBy("i", "value").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("i").agg(F.sum("n").alias("non_null_count"), F.count(F.lit(1)).alias("unique_values"))
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))
    found = _named(df).join(values, "i", "left").unionByName(rows, allowMissingColumns=True)
    whole = Window.partitionBy()   # over one row per column and the row of totals
    total = lambda c: F.max(c).over(whole).cast("long")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)   # noqa: E731  a column of nulls has no values
    return found.select("i", "column_name", zero("non_null_count"), (total("_rows") - F.coalesce("non_null_count", F.lit(0))).alias("null_count"),
                        "data_type", zero("unique_values"), total("duplicates").alias("duplicates")).filter("i is not null").drop("i")


def profile_sketches(df: DataFrame, lg_k: int = 14) -> DataFrame:
    """A profile that adds up over loads: per column ``rows``, ``non_null_count`` and ``sketch`` (of its different values),
    and one row named ``*`` for whole rows. One pass; about 16 KB a column, whatever the rows."""
    whole = F.struct(F.lit(len(df.columns)).alias("i"), F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
                     .alias("value"))
    made = F.array(*[F.struct(F.lit(i).alias("i"), _text(f.name, f.dataType).alias("value")) for i, f in enumerate(df.schema.fields)],
                   whole)
    found = df.select(F.inline(made)).groupBy("i").agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("non_null_count"),
                                                       F.hll_sketch_agg("value", lg_k).alias("sketch"))
    names = _named(df).unionByName(df.sparkSession.createDataFrame([(len(df.columns), "*", "row")], "i int, column_name string, data_type string"))
    return found.join(names, "i").select("column_name", "data_type", "rows", "non_null_count", "sketch")


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all loads whose ``profile_sketches`` rows are given; distinct counts are estimates (about 1 %)."""
    one = sketches.groupBy("column_name", "data_type").agg(
        F.sum("rows").alias("rows"), F.sum("non_null_count").alias("non_null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_values"))
    whole = F.max(F.when(F.col("column_name") == "*", F.col("rows") - F.least("unique_values", "rows"))).over(Window.partitionBy())
    return (one.withColumn("duplicates", whole).filter("column_name <> '*'")
            .select("column_name", "non_null_count", (F.col("rows") - F.col("non_null_count")).alias("null_count"), "data_type",
                    F.least("unique_values", "non_null_count").alias("unique_values"), "duplicates"))


def non_null_counts(df: DataFrame) -> DataFrame:
    """``column_name, non_null_count`` for every column, from one aggregate."""
    one = df.agg(*[F.count(F.col(c)).alias(f"_nn{i}") for i, c in enumerate(df.columns)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                                   F.col(f"_nn{i}").alias("non_null_count"))
                                          for i, c in enumerate(df.columns)])))
