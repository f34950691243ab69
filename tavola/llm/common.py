"""Helpers shared by the corpus operators: word pattern, keys, shared scratch folder, byte files on it."""

from __future__ import annotations

import os
import pathlib
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import materialize as table  # noqa: F401  written once, lineage cut
from ..operators.materialize import scratch_folder
from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Arrow batches handed to Python hold at most this many rows and about this many bytes.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on: bounded Arrow batches, the shared checkpoint folder, this package on the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, whatever their own path holds (once per context)."""
    sc = spark.sparkContext
    if not getattr(sc, "_tavola_shipped", False):
        top = pathlib.Path(__file__).resolve().parents[1]
        archive = pathlib.Path(tempfile.mkdtemp(prefix="tavola-py-")) / "tavola.zip"   # read by the driver alone
        with zipfile.ZipFile(archive, "w") as z:
            for path in sorted(top.rglob("*.py")):
                z.write(path, path.relative_to(top.parent))
        sc.addPyFile(str(archive))
        sc._tavola_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """URI of a new folder on the shared checkpoint storage, owned by the session like its written tables."""
    return re.sub(r"^file:/+", "file:///", scratch_folder(spark, name))


def drop_scratch(spark: SparkSession, uri: str) -> None:
    """Delete a scratch folder through the cluster's file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def present_key(c: Column) -> Column:
    """A never-null string key for a nullable column; null sorts and groups apart from every value."""
    return F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))


# --- byte files on the shared folder, used inside tasks ---------------------------------------------------------

def _open_fs(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))


def write_file(uri: str, chunks: Iterable[bytes]) -> int:
    """Write a file under a private name, then move it to ``uri``: a retried task replaces it whole."""
    fs, path = _open_fs(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part, n = f"{path}.{uuid.uuid4().hex}", 0
    with fs.open_output_stream(part) as out:
        for chunk in chunks:
            out.write(chunk)
            n += len(chunk)
    fs.move(part, path)
    return n


def open_file(uri: str):
    """Random-access reader of a shared file."""
    fs, path = _open_fs(uri)
    return fs.open_input_file(path)


def read_range(uri: str, start: int, size: int) -> bytes:
    with open_file(uri) as f:
        f.seek(start)
        return f.read(size)


def map_array(uri: str, dtype):
    """Memory-map an array file; from a store that cannot be mapped it goes through an unnamed spool file."""
    import numpy as np
    from pyarrow import fs as pafs
    fs, path = _open_fs(uri)
    if fs.get_file_info(path).size == 0:
        return np.empty(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    spool = tempfile.TemporaryFile()
    with fs.open_input_stream(path) as f:
        shutil.copyfileobj(f, spool)
    spool.flush()
    return np.memmap(spool, dtype, "r")
