"""Session defaults: UTC, ANSI on, AQE on, and a shared checkpoint folder."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",   # rows that lie by order join by order and line where they lie
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "tavola",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Set the SQL confs the library relies on for an existing session."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.requireAllClusterKeysForCoPartition"):
        spark.conf.set(key, DEFAULT_CONF[key])
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    ``spark.checkpoint.dir`` names it and is read from the session. Where it is
    unset, a folder in the warehouse is used; a warehouse on the machine's own
    disk is not shared by a cluster, which must name the folder itself.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not configured and not sc.master.startswith("local") and re.match(r"file:|/", warehouse):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    sc.setCheckpointDir(configured or f"{warehouse}/_tavola")
    return sc.getCheckpointDir()
