"""Stored query results with an age limit, shared by sessions."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MAX_AGE = 3600.0   # fixed value: seconds a dashboard's tables stay fresh
PREFIX = "result-"


def cached(df: DataFrame, root: str, max_age: float = MAX_AGE, now: Callable[[], float] = time.time) -> DataFrame:
    """``df``'s rows from a stored result under ``root``, computed and stored first where there is none to use.

    A stored result is used when it came from the same plan over the same
    input files (names, lengths and times of change) and is no older than
    ``max_age`` seconds. It lies on shared storage, so other sessions find it;
    a result is only seen once it is whole, and of two sessions that compute it
    at once either one's may be used. Plans whose result changes from run to
    run (random numbers, the current time) should not be cached.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    key = plan_key(df)
    found = _newest(spark, root, key)
    if found is not None and now() - found[0] <= max_age:
        return spark.read.schema(df.schema).parquet(found[1])
    path = f"{root}/{PREFIX}{key}/{int(now() * 1000)}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_key(df: DataFrame) -> str:
    """A digest of the plan, independent of the names Spark numbers columns by, and of its input files as they are now."""
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized()
    text = [str(plan.semanticHash()), re.sub(r"plan_id=\\d+", "", plan.treeString()), df.schema.json(), *sorted(_files(df))]
    return hashlib.sha256("\n".join(text).encode()).hexdigest()[:40]


def drop_expired(spark: SparkSession, root: str, max_age: float = MAX_AGE, now: Callable[[], float] = time.time) -> int:
    """Delete stored results older than ``max_age``; returns how many went. Readers of old results should have ended."""
    fs, path = _fs(spark, root)
    old = [r.getPath() for k in (fs.listStatus(path) if fs.exists(path) else []) if k.getPath().getName().startswith(PREFIX)
           for r in fs.listStatus(k.getPath()) if now() - int(r.getPath().getName()) / 1000 > max_age]
    return sum(bool(fs.delete(p, True)) for p in old)


def _files(df: DataFrame) -> set[str]:
    """Name, length and time of change of every input file, listed by folder."""
    wanted = set(df.inputFiles())
    found = set()
    for folder in {f.rpartition("/")[0] for f in wanted}:
        fs, path = _fs(df.sparkSession, folder)
        for s in fs.listStatus(path):
            found.add((_plain(s.getPath().toString()), s.getLen(), s.getModificationTime()))
    named = {_plain(f) for f in wanted}
    return {f"{name} {size} {at}" for name, size, at in found if name in named}


def _plain(uri: str) -> str:
    from urllib.parse import unquote
    return unquote(re.sub(r"^file:/*", "/", uri))


def _newest(spark: SparkSession, root: str, key: str) -> tuple[float, str] | None:
    """When the newest whole result of a key was computed, and where it is."""
    fs, path = _fs(spark, f"{root}/{PREFIX}{key}")
    if not fs.exists(path):
        return None
    done = [(int(s.getPath().getName()) / 1000, s.getPath()) for s in fs.listStatus(path)]
    done = [(at, p) for at, p in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(((at, p.toString()) for at, p in done), default=None)


def _fs(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
