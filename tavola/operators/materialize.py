"""Cut lineage of a reused intermediate by writing it to the shared checkpoint folder."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

PREFIX = "tavola-"   # names of the folders this module writes begin so


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it from there.

    Used where a plan reads the same intermediate several times (counts,
    samples, boundary facts, final pass): it is computed once, a lost executor
    does not send the work back to the source tables, nothing stays in
    executors' memory, and the planner knows the real size. The folder belongs
    to the session: ``release`` deletes all of its folders when their results
    have been used, ``sweep`` those that ended sessions have left.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the checkpoint folder, owned by the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{PREFIX}{name}-{uuid.uuid4().hex[:12]}"
    owned(spark).append(path)
    return path


def owned(spark: SparkSession) -> list[str]:
    """Folders the session has written and not released."""
    sc = spark.sparkContext
    if not hasattr(sc, "_tavola_folders"):
        sc._tavola_folders = []
    return sc._tavola_folders


def release(spark: SparkSession) -> int:
    """Delete the session's folders; frames that read them must not be used any more. Returns how many were deleted."""
    folders = owned(spark)
    found = sum(_delete(spark, path) for path in folders)
    folders.clear()
    return found


def sweep(spark: SparkSession, hours: float = 72) -> int:
    """Delete folders under the checkpoint folder that nothing has been written to for ``hours``: those of sessions that
    ended without ``release``. Run it daily with ``hours`` above the longest job. Returns how many were deleted."""
    root = ensure_checkpoint_dir(spark)
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    # A checkpoint folder has one folder per application: the others' lie beside it.
    places = [top] + [s.getPath() for s in _list(spark, top.getParent()) if s.isDirectory() and s.getPath().getName() != top.getName()]
    limit = (time.time() - hours * 3600) * 1000
    old = [s.getPath().toString() for place in places for s in _list(spark, place)
           if s.getPath().getName().startswith(PREFIX) and s.getModificationTime() < limit]
    return sum(_delete(spark, path) for path in old)


def written_bytes(written: DataFrame) -> int:
    """Bytes of the files a ``materialize`` result reads."""
    return int(str(written._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _list(spark: SparkSession, path) -> list:
    fs = _fs(spark, path)
    return list(fs.listStatus(path)) if fs.exists(path) and fs.getFileStatus(path).isDirectory() else []


def _delete(spark: SparkSession, uri: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return bool(_fs(spark, path).delete(path, True))
