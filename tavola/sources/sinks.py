"""Writers: partitioned and plain overwrite, compaction, table registration."""

from __future__ import annotations

import re
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


RECORDS_PER_FILE = 10_000_000


def partition_column(column: str, grain: str | None) -> str:
    """Name of the partition column for a date column: itself, or ``<column>_<grain>``."""
    return column if grain is None else f"{column}_{grain}"


def write_partitioned(df: DataFrame, path: str, column: str = "order_date", mode: str = "overwrite",
                      dynamic: bool = False, max_records_per_file: int = RECORDS_PER_FILE,
                      legacy_format: bool = False, grain: str | None = None) -> None:
    """Write partitioned by ``column``, rebalanced by its values.

    ``grain`` (``month``, ``quarter`` or ``year``) partitions by the start of
    that period instead, in a column of its own (``partition_column``): fewer
    and larger folders where a day holds little.

    Without a shuffle every task writes a file into every partition value it
    touches (tasks × values small files). The rebalance hint shuffles once on
    the column: small values stay in one file each, and adaptive execution
    splits one with a large share of the rows over several tasks by measured
    size. Small shuffle partitions are not coalesced here: with many values the
    number of files, not their bytes, decides how long a task takes.
    ``dynamic=True`` replaces only the partition values present in ``df``.
    """
    spark = df.sparkSession
    if grain is not None:
        df = df.withColumn(partition_column(column, grain), F.trunc(column, grain))
        column = partition_column(column, grain)
    writer = (df.hint("rebalance", column).write.mode(mode).partitionBy(column)
              .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
              .option("maxRecordsPerFile", max_records_per_file))
    with _legacy_format(spark, legacy_format), _setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        writer.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", legacy_format: bool = False) -> None:
    with _legacy_format(df.sparkSession, legacy_format):
        df.write.mode(mode).parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of one write."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _legacy_format(spark: SparkSession, on: bool):
    """Parquet legacy decimal/integer encoding for readers that need it."""
    return _setting(spark, "spark.sql.parquet.writeLegacyFormat", "true" if on else "false")


def compact(spark: SparkSession, src: str, dst: str, files: int | None = None, partition_by: str | None = None) -> None:
    """Rewrite ``src`` into fewer files at a new path ``dst`` (never in place).

    A partitioned table is rebalanced by its partition values, so that small
    ones end in one file and a large one in several; another table goes into
    ``files`` files, or as many as its size asks for.
    """
    df = spark.read.parquet(src)
    if partition_by:
        write_partitioned(df, dst, partition_by)
    else:
        (df.repartition(files) if files else df.hint("rebalance")).write.mode("overwrite").parquet(dst)


FILE_BYTES = 128 << 20   # size compacted files aim at
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"   # fixed value: folder name of a null partition value


def partition_files(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``value`` (as in the folder's name), ``files`` and ``bytes`` of each partition, from the listing alone."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
              .select("path", "length"))   # contents are not read
    return (listed.groupBy(F.regexp_extract("path", f"/{column}=([^/]+)/", 1).alias("value"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))


def compact_partitions(spark: SparkSession, path: str, column: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite, in place, the partitions that lie in more files than their size asks for; the others are not read or touched.

    Returns ``partition_files`` as it was, with ``rewritten``. Rewritten
    partitions are staged and swapped in when all of them are written, so a
    failed run leaves the table as it was.
    """
    from ..operators.materialize import materialize
    found = materialize(partition_files(spark, path, column).withColumn(
        "rewritten", F.col("files") > F.ceil(F.col("bytes") / file_bytes)), "partition-files")
    values = [r[0] for r in found.filter("rewritten").select("value").collect()]   # at most one per partition value
    if values:
        table = spark.read.parquet(path)
        text = F.col(column).cast("string")
        chosen = text.isin([v for v in values if v != NO_VALUE])
        chosen = (chosen | F.col(column).isNull()) if NO_VALUE in values else chosen
        write_partitioned(table.filter(chosen), path, column, dynamic=True)
    return found


def register_tables(spark: SparkSession, root: str, names, cache: bool = False, database: str | None = None) -> dict[str, DataFrame]:
    """Expose written tables to SQL.

    Temp views by default. With ``database`` they become external tables of the
    session's catalog, which other sessions on the same metastore can query;
    registering again picks up what was written since, and a table that lies
    there already stays in place for its readers. ``cache=True`` keeps
    them in executor memory and disk; a cached table of the same name is
    dropped first, so that a refreshed table is never served from old blocks.
    """
    out = {}
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        path = f"{root.rstrip('/')}/{name}"
        full = f"`{database}`.`{name}`" if database else f"`{name}`"
        if spark.catalog.tableExists(full.replace("`", "")) and spark.catalog.isCached(full.replace("`", "")):
            spark.catalog.uncacheTable(full.replace("`", ""))
        if database:
            _register(spark, full, path)
        else:
            spark.read.parquet(path).createOrReplaceTempView(name)
        if cache:
            spark.catalog.cacheTable(full.replace("`", ""))
        out[name] = spark.table(full)
    return out


def _register(spark: SparkSession, full: str, path: str) -> None:
    """Create a catalog table, or let an existing one with the same place and columns see the files of now."""
    if spark.catalog.tableExists(full.replace("`", "")):
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'").first()
        same = place is not None and _normal(place["data_type"]) == _normal(path)
        if not same or {f.simpleString() for f in spark.table(full).schema} != {f.simpleString() for f in spark.read.parquet(path).schema}:
            spark.sql(f"DROP TABLE {full}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{path}'")
    if _is_partitioned(spark, full):
        spark.sql(f"MSCK REPAIR TABLE {full} SYNC PARTITIONS")
    spark.catalog.refreshTable(full)


def _normal(uri: str) -> str:
    return re.sub(r"^file:/*", "/", uri).rstrip("/")


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table.replace("`", "")))


def read_silver(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Silver sales, optionally only ``start <= order_date <= end`` (partition pruning)."""
    df = spark.read.parquet(path)
    coarse = [g for g in ("month", "quarter", "year") if partition_column("order_date", g) in df.columns]
    for bound, within in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            day = F.lit(bound).cast("date")
            df = df.filter(getattr(F.col("order_date"), within)(day))
            for grain in coarse:   # prunes the folders of longer periods
                df = df.filter(getattr(F.col(partition_column("order_date", grain)), within)(F.trunc(day, grain)))
    return df
