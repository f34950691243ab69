"""Token counts by scanning flat token files for the end-of-document id.

A token file is unsigned 16- or 32-bit little-endian ids and nothing else: no
index, no lengths. Files are cut into blocks; a task scans a block with one
vectorised comparison and returns what lies before its first separator,
between separators, and after its last. A prefix scan over the blocks of a file
adds the open ends together, so documents that cross blocks come out whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, read_range, scratch, table, write_file

BLOCK_BYTES = 4 << 20


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, uri: str, *, id_col: str = "doc_id", text_col: str = "text",
                      dtype: str = "<u2") -> DataFrame:
    """Tokenize whole documents into flat files under ``uri``, each document followed by ``end_id``.

    Special tokens' strings inside a text are ordinary text, so ``end_id`` ends
    documents only. Null text is an empty document. Returns (path, part, bytes,
    place, _id), one row per document: its file, the file's size, its place in
    the file and its id. Write the rows before reading them; that writes the
    files.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    id_type = source.schema["_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from .tokens import encoder
        part = TaskContext.get().partitionId()
        path, enc = f"{uri}/part-{part:06d}.ids", encoder(tokenizer, plain_specials=True)
        listed: list = []

        def chunks():
            for b in batches:
                ids, at = enc.encode(b.column("_t").to_pylist())
                if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                    raise ValueError(f"ids do not fit into {dtype}")
                if (ids == end_id).any():
                    raise ValueError("the end id occurs inside a document")
                listed.append(b.column("_id"))
                yield np.insert(ids, at[1:], end_id).astype(dtype).tobytes()

        size = write_file(path, chunks())
        if listed:
            place = 0
            for ids in listed:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(ids), pa.string()), pa.array([part] * len(ids), pa.int32()),
                     pa.array([size] * len(ids), pa.int64()), pa.array(range(place, place + len(ids)), pa.int64()), ids],
                    names=["path", "part", "bytes", "place", "_id"])
                place += len(ids)

    return source.mapInArrow(run, f"path string, part int, bytes long, place long, _id {id_type}")


def scan_block(data: bytes, end_id: int, dtype: str = "<u2"):
    """(separators, head, tail, lengths): ids before the first separator (all, if there is none) and after the last, and
    the lengths between neighbouring separators."""
    import numpy as np
    ids = np.frombuffer(data, dtype)
    at = np.flatnonzero(ids == end_id)
    if not len(at):
        return 0, len(ids), 0, at
    return len(at), int(at[0]), len(ids) - int(at[-1]) - 1, np.diff(at) - 1


def document_lengths(files: DataFrame, end_id: int, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, place, n_tokens): the length without the separator of every document in the files (path, bytes).

    ``place`` counts documents from 0 in file order. Ids after a file's last
    separator are a document cut short: it is listed too, when it has any ids.
    An empty file has no documents.
    """
    import numpy as np
    width = np.dtype(dtype).itemsize
    block_bytes -= block_bytes % width
    blocks = files.filter("bytes > 0").select("path", F.col("bytes").alias("size"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block_bytes).cast("long"))).alias("at"))
    blocks = blocks.repartition(max(64, files.sparkSession.sparkContext.defaultParallelism * 4), "path", "at")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for path, size, at in zip(*(b.column(c).to_pylist() for c in ("path", "size", "at"))):
                n, head, tail, inner = scan_block(read_range(path, at, min(block_bytes, size - at)), end_id, dtype)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (path, at, n, head, tail)] + [pa.array([inner], pa.list_(pa.int64()))],
                                                 names=["path", "at", "seps", "head", "tail", "inner"])

    scanned = table(blocks.mapInArrow(run, "path string, at long, seps long, head long, tail long, inner array<bigint>"), "token-blocks")
    # The prefix scan: one row per block of a file. ``open`` is what the blocks since the last separator left open.
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    runs = scanned.withColumn("_first", F.coalesce(F.sum("seps").over(before), F.lit(0)))
    since = Window.partitionBy("path", "_first").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # Blocks with the same number of separators before them form one run; the block that raised the count left its tail.
    last_tail = F.last(F.when(F.col("seps") > 0, F.col("tail")), ignorenulls=True).over(before)
    stitched = runs.withColumn("_open", F.coalesce(last_tail, F.lit(0))
                               + F.coalesce(F.sum(F.when(F.col("seps") == 0, F.col("head"))).over(since), F.lit(0))) \
        .withColumn("_end", F.lead("at").over(Window.partitionBy("path").orderBy("at")).isNull())
    whole = F.when(F.col("seps") > 0, F.concat(F.array(F.col("_open") + F.col("head")), F.col("inner"))) \
        .otherwise(F.array().cast("array<bigint>"))
    cut = F.when(F.col("seps") > 0, F.col("tail")).otherwise(F.col("_open") + F.col("head"))
    rest = F.when(F.col("_end") & (cut > 0), F.array(cut)).otherwise(F.array().cast("array<bigint>"))
    return stitched.select("path", "_first", F.posexplode(F.concat(whole, rest)).alias("_k", "n_tokens")) \
        .select("path", (F.col("_first") + F.col("_k")).alias("place"), "n_tokens")


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
                 dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens) of whole documents, counted from flat token files that hold them.

    Null and empty texts have 0 tokens; repeated rows give repeated result
    rows; an empty table gives none; extra columns are left out. The files are
    deleted when the counts are written.
    """
    spark = docs.sparkSession
    uri = scratch(spark, "token-files")
    listed = table(write_token_files(docs, tokenizer, end_id, uri, id_col=id_col, text_col=text_col, dtype=dtype), "token-listing")
    files = listed.filter("place = 0").select("path", "bytes")
    lengths = table(document_lengths(files, end_id, dtype, block_bytes), "token-lengths")
    drop_scratch(spark, uri)
    same = (listed["path"] == lengths["path"]) & (listed["place"] == lengths["place"])
    return listed.join(lengths, same).select(F.col("_id").alias(id_col), "n_tokens")
