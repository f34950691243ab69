"""Bronze readers: parquet or CSV, declared schema, lower-cased names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.dates import as_timestamp
from ..functions.labels import normalise_bool

CORRUPT = "_corrupt_record"


@dataclass
class Bronze:
    order_items: DataFrame
    order_item_options: DataFrame
    date_dim: DataFrame
    dedup_order: tuple[str, ...] | None = None
    drop_after_dedup: tuple[str, ...] = ()
    corrupt: DataFrame | None = None   # (source, line) of text lines that did not parse


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Match column names case-insensitively: ``ORDER_ID`` → ``order_id``."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 recursive: bool = True, merge_schema: bool = False, rescue: str | None = None) -> DataFrame:
    """Read a Bronze parquet table, including nested ``YYYY/MM/DD`` layouts.

    Without ``recursiveFileLookup`` a date-nested tree yields no rows when a
    schema is given; with it every file under ``path`` is read. Columns are
    lower-cased, and when ``schema`` is given, selected and cast to it
    (missing columns become nulls — schema drift tolerance). With ``rescue``
    what the schema would lose is kept in a column of that name (``conform``).
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = lower_case_columns(reader.parquet(path))
    return conform(df, schema, rescue) if schema is not None else df


# --- loads -----------------------------------------------------------------------------------------------------------

LOAD = r"/(\d{4}/\d{2}/\d{2})/[^/]*$"   # date folders, one per full reload
MARKER = "_SUCCESS"                       # fixed value: file a finished write leaves in its folder


def list_loads(spark: SparkSession, path: str) -> DataFrame:
    """One row per load under ``path``: ``load`` (``YYYY/MM/DD``, empty for files outside date folders), ``files``, ``bytes``,
    ``modified`` (newest file), ``complete``.

    Files are listed, not read. A load is complete when its folder holds the
    marker of a finished write; where no load has one (a replication service
    writes none), every load counts as complete.
    """
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select("path", "length", "modificationTime"))
    found = (listed.groupBy(F.regexp_extract("path", LOAD, 1).alias("load"))
             .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified")))
    marked = [(r["load"],) for r in found.select("load").collect() if _has_marker(spark, f"{path}/{r['load']}")]   # one per day at most
    if not marked:
        return found.withColumn("complete", F.lit(True))
    done = spark.createDataFrame(marked, "load string").withColumn("_done", F.lit(True))
    return found.join(done, "load", "left").withColumn("complete", F.coalesce("_done", F.lit(False))).drop("_done")


def _has_marker(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{MARKER}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def latest_load(spark: SparkSession, path: str) -> str:
    """Folder of the newest complete load under ``path``; ``path`` itself where there are no date folders.

    A daily full reload leaves one date folder per day; reading them all would
    count every row once per load. An unfinished newer load is passed over.
    """
    path = path.rstrip("/")
    newest = list_loads(spark, path).filter("complete").agg(F.max("load")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no complete load under {path}")
    return f"{path}/{newest}" if newest else path


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             corrupt_column: str | None = CORRUPT) -> DataFrame:
    """Read a CSV export with a header as text columns (PERMISSIVE).

    Every value is read as text; ``conform`` gives it its declared type, where
    a bad value becomes null instead of failing the job.
    """
    text = schemas.as_text(schema)
    if corrupt_column:
        text = text.add(T.StructField(corrupt_column, T.StringType()))
    reader = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
              .option("recursiveFileLookup", "true").option("columnPruning", "false").schema(text))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return lower_case_columns(reader.csv(path))


def conform(df: DataFrame, schema: T.StructType, rescue: str | None = None) -> DataFrame:
    """Select ``schema``'s columns in order, each in its declared type.

    Absent columns and values that do not fit become nulls. Booleans may come
    as 0/1 or as words, timestamps as text. ``rescue`` names a further column
    that keeps what the declared schema would lose, as JSON: values of columns
    it does not know, and, as they came, values that do not fit their declared
    type or would lose digits in it; null where nothing is lost.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = [_typed(f, types.get(f.name)).alias(f.name) for f in schema.fields]
    if rescue is None:
        return df.select(*typed)
    declared = {f.name: f for f in schema.fields}
    lost = [F.when(_loses(declared[c], t), F.col(c)).alias(c) if c in declared else F.col(c) for c, t in types.items()
            if c not in declared or declared[c].dataType != t]
    kept = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}")) if lost else F.lit(None).cast("string")
    return df.select(*typed, kept.alias(rescue))


def _loses(field: T.StructField, found: T.DataType) -> Column:
    """A value is there, and its declared type holds none or another number."""
    typed = _typed(field, found)
    lost = F.col(field.name).isNotNull() & typed.isNull()
    if isinstance(found, T.NumericType) and isinstance(field.dataType, T.NumericType):
        lost = lost | (typed.cast("decimal(38,18)") != F.col(field.name).try_cast("decimal(38,18)"))
    return F.coalesce(lost, F.lit(False))


def _typed(field: T.StructField, found: T.DataType | None) -> Column:
    if found is None:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        return as_timestamp(field.name, found)
    if isinstance(field.dataType, T.BooleanType):
        return normalise_bool(field.name)
    if isinstance(field.dataType, T.IntegerType) and isinstance(found, T.StringType):
        return F.col(field.name).try_cast(T.DecimalType(12, 2)).try_cast(field.dataType)   # "2" and "2.0"
    return F.col(field.name).try_cast(field.dataType)


def read_bronze(spark: SparkSession, root: str, fmt: str = "parquet", load: str = "latest") -> Bronze:
    """The three Bronze tables under ``root`` (``order_items/`` …), conformed to the declared schemas.

    Of a table in date folders the newest complete load is read
    (``latest_load``); ``load="all"`` reads them all as one table.
    CSV lines that do not parse are kept as text in ``corrupt`` (source, line)
    and stay out of the tables.
    """
    root = root.rstrip("/")
    tables = {"order_items": schemas.ORDER_ITEMS, "order_item_options": schemas.ORDER_ITEM_OPTIONS, "date_dim": schemas.DATE_DIM}
    place = {name: f"{root}/{name}" if load == "all" else latest_load(spark, f"{root}/{name}") for name in tables}
    if fmt != "csv":
        return Bronze(*[read_parquet(spark, place[name], schema) for name, schema in tables.items()])
    good, corrupt = [], None
    for name, schema in tables.items():
        text = read_csv(spark, place[name], schema)
        good.append(conform(text.filter(F.col(CORRUPT).isNull()), schema))
        # Spark refuses a query that reads the corrupt column alone, so an empty part of another one goes with it.
        other = F.substring(F.coalesce(F.col(schema.names[0]), F.lit("")), 1, 0)
        bad = text.filter(F.col(CORRUPT).isNotNull()).select(F.lit(name).alias("source"), F.concat(F.col(CORRUPT), other).alias("line"))
        corrupt = bad if corrupt is None else corrupt.unionByName(bad)
    return Bronze(*good, corrupt=corrupt)
