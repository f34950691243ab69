"""Incremental ingest of change files: file stream → micro-batch merge → versioned, bucketed state.

The keyed state lies in hash buckets of about ``BUCKET_BYTES`` each; their
number is part of a commit and doubles when the state has outgrown it, with
a batch that rewrites all of it. Version n is a small commit
file, ``commits/<n>``, that names for each bucket the data folder holding it;
``data/<n>/bucket=<b>`` holds the buckets that batch n - 1 touched. A batch
reads and rewrites only the buckets its keys fall into, writes its data
(overwriting what a failed attempt left), and then creates the commit file
under its final name in one step. A version without a commit file does not
exist, so a batch replayed after a crash is applied in full, and one that was
committed is skipped. Old commits beyond ``keep`` and data that no kept commit
names are removed. Versions are listed from file names, never from data.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import live, merge_changes
from ..operators.materialize import materialize, written_bytes

BUCKET = "tavola_bucket"
BUCKET_BYTES, KEEP = 32 << 20, 3   # a bucket is one task's work
HOT_CHANGES = 2_000_000   # changes of one bucket in a batch beyond which they are reduced to a row per key before the merge


class StateStore:
    """Commit files and data folders of one state, through the cluster's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _names(self, folder: str) -> list[int]:
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(int(n) for n in (s.getPath().getName() for s in self._fs.listStatus(path)) if n.isdigit())

    def versions(self) -> list[int]:
        return self._names("commits")

    def read_commit(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"commits/{version}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, version: int, keys: Sequence[str], buckets: int, folders: dict[int, int]) -> None:
        text = json.dumps({"keys": list(keys), "buckets": buckets, "folders": {str(b): v for b, v in sorted(folders.items())}})
        draft = self._path(f"commits/_{version}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self._fs.rename(draft, self._path(f"commits/{version}")):
            raise OSError(f"could not commit version {version} of {self.root}")

    def data(self, version: int) -> str:
        return f"{self.root}/data/{version}"

    def size(self, folders: dict) -> int:
        """Bytes of the data that a commit names."""
        named = (self._path(f"data/{v}/{BUCKET}={b}") for b, v in folders.items())
        return sum(self._fs.getContentSummary(p).getLength() for p in named)

    def clean(self, keep: int) -> None:
        versions = self.versions()
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"commits/{v}"), False)
        kept = versions[-keep:]
        named = {v for k in kept for v in self.read_commit(k)["folders"].values()}
        for v in self._names("data"):
            if v not in named and v <= kept[-1]:
                self._fs.delete(self._path(f"data/{v}"), True)


def _with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _read(store: StateStore, folders: dict[str, int], wanted: Sequence[int] | None = None) -> DataFrame | None:
    """The named buckets (default: all) from their data folders."""
    by_version: dict[int, list[int]] = {}
    for bucket, version in folders.items():
        if wanted is None or int(bucket) in wanted:
            by_version.setdefault(version, []).append(int(bucket))
    found = None
    for version, buckets in sorted(by_version.items()):
        part = store.spark.read.parquet(store.data(version)).filter(F.col(BUCKET).isin(buckets))   # folder pruning
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return found


def committed_versions(spark: SparkSession, state_root: str) -> list[int]:
    return StateStore(spark, state_root).versions()


def read_state(spark: SparkSession, state_root: str, version: int | None = None) -> DataFrame | None:
    """The state at a kept version (default: the latest), deletes included as tombstones."""
    store = StateStore(spark, state_root)
    versions = store.versions()
    if not versions or (version is not None and version not in versions):
        return None
    state = _read(store, store.read_commit(versions[-1] if version is None else version)["folders"])
    return None if state is None else state.drop(BUCKET)


def _write(store: StateStore, version: int, rows: DataFrame, dealt: bool = False) -> list[int]:
    """Write bucketed rows as the data of a version; the buckets written. ``dealt``: the rows lie by bucket already."""
    (rows if dealt else rows.hint("rebalance", BUCKET)).write.mode("overwrite").option("compression", "zstd") \
        .partitionBy(BUCKET).parquet(store.data(version))
    names = [s.getPath().getName() for s in store._fs.listStatus(store._path(f"data/{version}"))]
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]


def _buckets_for(size: int, bucket_bytes: int) -> int:
    """A power of two, so that doubling splits every bucket in two."""
    return 1 << max(0, math.ceil(size / bucket_bytes) - 1).bit_length()


def write_initial_state(base: DataFrame, state_root: str, keys: Sequence[str], buckets: int | None = None,
                        bucket_bytes: int = BUCKET_BYTES) -> None:
    """Version 0: the full-load snapshot the changes apply to, in as many buckets as its written size asks for."""
    store = StateStore(base.sparkSession, state_root)
    if buckets is None:
        base = materialize(base, "snapshot")
        buckets = _buckets_for(written_bytes(base), bucket_bytes)
    written = _write(store, 0, _with_bucket(base, keys, buckets))
    store.commit(0, keys, buckets, dict.fromkeys(written, 0))


def merge_batch(batch: DataFrame, batch_id: int, state_root: str, keys: Sequence[str], order: Sequence[str],
                buckets: int | None = None, keep: int = KEEP, bucket_bytes: int = BUCKET_BYTES,
                merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
                on_merged: Callable[[DataFrame, DataFrame, DataFrame, int], None] | None = None) -> None:
    """Apply one micro-batch as version ``batch_id + 1``.

    ``merge(state, changes)`` gives the new rows of the touched buckets
    (default: the latest row per key). ``on_merged(before, after, changes,
    batch_id)`` runs on their rows before the version is committed, so after a
    failure it may run again with the same number. ``buckets`` counts only
    where there is no state yet.
    """
    store = StateStore(batch.sparkSession, state_root)
    done = store.versions()
    if done and done[-1] > batch_id:
        return                                       # replayed batch: committed before
    folders: dict[str, int] = {}
    grown = False
    if done:
        last = store.read_commit(done[-1])
        folders, held = last["folders"], last["buckets"]
        buckets = max(held, _buckets_for(store.size(folders), bucket_bytes) // 2)   # at twice the size, in good time
        grown = buckets > held
    elif buckets is None:
        batch = materialize(batch, "snapshot")
        buckets = _buckets_for(written_bytes(batch), bucket_bytes)
    changes = _with_bucket(batch, keys, buckets)
    counts = dict(changes.groupBy(BUCKET).count().collect())   # at most `buckets`
    touched = list(counts)
    current = _read(store, folders, None if grown else touched)
    if current is None:   # none of these buckets yet: no rows, in the state's columns
        whole = _read(store, folders)
        current = (changes if whole is None else whole).limit(0)
    current = current.drop(BUCKET)
    if merge is None:   # one shuffle by bucket serves the merge and the write
        merged = merge_changes(_with_bucket(current, keys, buckets), changes, keys, order, deal_by=BUCKET,
                               reduce=bool(counts) and max(counts.values()) > HOT_CHANGES)
    else:
        merged = _with_bucket(merge(current, changes.drop(BUCKET)), keys, buckets)
    written = _write(store, batch_id + 1, merged, dealt=merge is None) if touched or grown else []
    if on_merged is not None and written:
        after = store.spark.read.parquet(store.data(batch_id + 1)).drop(BUCKET)
        on_merged(current, after, changes.drop(BUCKET), batch_id)
    kept = {} if grown else {int(b): v for b, v in folders.items()}
    store.commit(batch_id + 1, keys, buckets, {**kept, **dict.fromkeys(written, batch_id + 1)})
    store.clean(keep)


def start_ingest(spark: SparkSession, source: str, schema: T.StructType, state_root: str, checkpoint: str,
                 keys: Sequence[str], order: Sequence[str], available_now: bool = True,
                 max_files_per_trigger: int | None = None, processing_time: str = "1 minute", **merging):
    """Start the stream; returns the ``StreamingQuery``.

    ``available_now`` processes everything present and stops (the daily
    refresh); otherwise a batch starts every ``processing_time``. ``merging``
    goes to ``merge_batch``.
    """
    keys, order = list(keys), list(order)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.parquet(source).writeStream
              .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, state_root, keys, order, **merging))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def current_rows(spark: SparkSession, state_root: str, op_col: str = "op") -> DataFrame | None:
    state = read_state(spark, state_root)
    return None if state is None else live(state, op_col)
