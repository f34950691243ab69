"""Documents as token ids in compressed files, in ascending order of their names.

The rows are dealt by ranges of the name and the beginning of the text, each
range sorted, so that files in order hold the documents in order and rows that
share a name spread over many ranges. A task closes a file after FILE_IDS ids,
so a range with many rows is never held whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import open_file, scratch, table, write_file

RANGE_BYTES, FILE_IDS = 16 << 20, 14_000_000   # text for each range; ids after which a file is closed
KEY_CHARS = 64   # characters of the text in the key that rows are dealt by


def write_documents(docs: DataFrame, tokenizer: str, *, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                    uri: str | None = None) -> DataFrame:
    """Encode whole documents, each followed by ``end_id``, and return the written manifest.

    Manifest: (path, part, seq, documents, ids, start), ``start`` being the ids
    in all files before. Null names come first; rows with one name are ordered
    by their text (null first). Null text is the end id alone. An empty table
    writes no file.
    """
    from .idcodec import encode_file, narrow
    from .tokens import encoder
    spark = docs.sparkSession
    uri = uri or scratch(spark, "id-files")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"))
    size = rows.agg(F.sum(F.octet_length("_t"))).first()[0] or 0
    order = [F.col("_id").asc_nulls_first(), F.col("_t").asc_nulls_first()]
    key = F.substring("_t", 1, KEY_CHARS).asc_nulls_first()   # sorts as the text does
    dealt = rows.repartitionByRange(1 + size // RANGE_BYTES, order[0], key).sortWithinPartitions(*order)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, enc, seq = TaskContext.get().partitionId(), encoder(tokenizer), 0
        names: list = []
        documents: list = []
        held = 0

        def closed():
            nonlocal seq, held
            path = f"{uri}/part-{part:06d}-{seq:06d}.ids"
            size = write_file(path, [encode_file(names, documents)])
            row = {"path": [path], "part": [part], "seq": [seq], "documents": [len(names)], "ids": [held], "bytes": [size]}
            seq, held = seq + 1, 0
            names.clear()
            documents.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()),
                                                                     *((c, pa.int64()) for c in ("documents", "ids", "bytes"))]))

        for b in batches:
            ids, at = enc.encode(b.column("_t").to_pylist())
            ids, at = narrow(np.insert(ids, at[1:], end_id)), (at + np.arange(len(at))).tolist()
            for name, x, y in zip(b.column("_id").to_pylist(), at, at[1:]):
                names.append(name)
                documents.append(ids[x:y])
                held += y - x
                if held >= FILE_IDS:
                    yield closed()
        if names:
            yield closed()

    written = table(dealt.mapInArrow(run, "path string, part int, seq int, documents long, ids long, bytes long"), "id-manifest")
    # One row per file.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_documents(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of the files in the manifest; every block's checksum is verified."""
    from .idcodec import decode_file

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                with open_file(path) as f:
                    names, documents = decode_file(f.read())
                for i in range(0, len(names), 20_000):
                    part = documents[i:i + 20_000]
                    n = np.array([len(d) for d in part], np.int64)
                    crc = [zlib.crc32(d.astype("<u4")) for d in part]
                    cols = [pa.array(names[i:i + 20_000], pa.int64()), pa.array(start + np.cumsum(n) - n), pa.array(n),
                            pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.array([d.astype(np.int64) for d in part], pa.list_(pa.int64())))
                    start += int(n.sum())
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    spark = manifest.sparkSession
    dealt = manifest.select("path", "start").repartition(max(64, 4 * spark.sparkContext.defaultParallelism), "path")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<bigint>" if with_ids else ""))
