"""Dictionary-compressed WARC archives.

A Zstandard dictionary is built from a bounded sample of the records and
written first in every archive, inside a skippable frame, so an archive can be
read on its own. Each record is a frame of its own, compressed with the
dictionary. Payloads that occur more than once are stored with the record of
the largest page id; the others are revisit records that point to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import open_file, scratch, table, write_file

SKIPPABLE = 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"
ID = "<urn:page:{}>"
#: The dictionary: its size, and the sample it is built from (smallest hashes first; of a larger payload a piece of this size).
DICT_BYTES, SAMPLE_RECORDS, SAMPLE_RECORD_BYTES = 64 << 10, 1000, 64 << 10
READ = 1 << 18


def build_dictionary(records: list[bytes], size: int = DICT_BYTES) -> bytes:
    """Train on the records; with too few of them, the records themselves are the dictionary."""
    import zstandard
    if not records:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _dictionary(data: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(data) if data else None


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC record. A revisit has no body; its headers keep the payload's digest and length."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {ID.format(_id(page_id))}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    if url is not None:
        from urllib.parse import quote
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=-._~"))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {ID.format(_id(refers_to))}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(page_id) -> str:
    return "null" if page_id is None else str(page_id)


def parse_record(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload (None for a revisit) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n" or len(block) != int(fields["Content-Length"]):
        raise ValueError("record cut short")
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(body) != length or digest(body) != said):
        raise ValueError("payload does not match its digest")

    def page(name):
        value = fields[name].removeprefix("<urn:page:").removesuffix(">")
        return None if value == "null" else int(value)

    return {"page_id": page("WARC-Record-ID"), "payload_bytes": length, "payload_digest": said, "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To") if revisit else None, "payload": None if revisit else body}


def archive_frames(dictionary: bytes, records: Iterable[bytes], level: int = 3) -> Iterator[bytes]:
    """The skippable frame with the dictionary, then a frame for each record."""
    import zstandard
    d = _dictionary(dictionary)
    c = zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=True) if d else \
        zstandard.ZstdCompressor(level=level, write_checksum=True)
    yield struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary
    for r in records:
        yield c.compress(r)


def archive_records(f) -> Iterator[bytes]:
    """The records of an open archive, one at a time."""
    import zstandard
    magic, size = struct.unpack("<II", f.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    d = _dictionary(f.read(size))
    c = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    rest = b""
    while True:
        rest = rest or f.read(READ)
        if not rest:
            return
        one, out = c.decompressobj(), io.BytesIO()
        while True:
            out.write(one.decompress(rest))
            if one.eof:
                rest = one.unused_data
                break
            rest = f.read(READ)
            if not rest:
                raise ValueError("archive cut short")
        yield out.getvalue()


def plan_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) of the rows (page_id, url, payload).

    Of equal payloads of at least ``min_bytes`` the largest page_id is stored
    (null is below any). Rows that repeat it with the same payload are stored
    again, since a record cannot revisit itself.
    """
    keyed = pages.withColumn("_d", F.sha1("payload")).withColumn("_n", F.length("payload"))
    best = keyed.groupBy("_d", "_n").agg(F.max("page_id").alias("_best"))
    best = best.select(F.col("_d").alias("_bd"), F.col("_n").alias("_bn"), "_best")
    # An inner join: a payload shared by a third of all pages is split by adaptive execution.
    joined = keyed.join(best, (F.col("_d") == F.col("_bd")) & (F.col("_n") == F.col("_bn")))
    again = (F.col("_n") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_best"))
    return joined.select("page_id", "url", "payload", F.when(again, F.col("_best")).alias("refers_to"), again.alias("revisit"))


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, uri: str | None = None) -> DataFrame:
    """Write every page into archives under ``uri`` and return their written manifest (path, records, bytes).

    Null html is an empty payload, a null url is left out. Each task writes one
    archive, under a private name first, so a retried task replaces it; only
    archives in the manifest count. An empty table writes no archive.
    """
    spark = pages.sparkSession
    uri = uri or scratch(spark, "warc")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"))
    drawn = F.pmod(F.xxhash64("page_id"), F.lit(1 << 40))
    near = int(min(1.0, 2 * SAMPLE_RECORDS / max(1, pages.count())) * (1 << 40))
    # A payload above the bound gives a piece at an offset drawn by another hash, for training only.
    offset = F.pmod(F.xxhash64("page_id", F.lit("offset")), F.length("payload") - SAMPLE_RECORD_BYTES + 1).cast("int")
    piece = F.when(F.length("payload") <= SAMPLE_RECORD_BYTES, F.col("payload")) \
        .otherwise(F.substr("payload", offset + 1, F.lit(SAMPLE_RECORD_BYTES)))
    sample = rows.filter(drawn < near).withColumn("payload", piece).orderBy(drawn, "page_id").limit(SAMPLE_RECORDS).collect()
    dictionary = build_dictionary([record_bytes(r["page_id"], r["url"], bytes(r["payload"])) for r in sample])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        name = f"{uri}/part-{TaskContext.get().partitionId():06d}.warc.zst"
        n = 0

        def records():
            nonlocal n
            for b in batches:
                for r in b.to_pylist():
                    n += 1
                    yield record_bytes(r["page_id"], r["url"], r["payload"], r["refers_to"], r["revisit"])

        it = records()
        first = next(it, None)
        if first is not None:
            from itertools import chain
            size = write_file(name, archive_frames(dictionary, chain([first], it)))
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [n], "bytes": [size]})

    return table(plan_revisits(rows, min_bytes).mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives in the manifest, checked against its digest and its archive's count of records."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split()[0] for c in schema.split(", ")] + (["payload"] if with_payload else [])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for path, count in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                held, size, seen = [], 0, 0
                with open_file(path) as f:
                    for data in archive_records(f):
                        r = parse_record(data)
                        seen += 1
                        held.append({k: r[k] for k in names})
                        size += len(data) if with_payload else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=out)
                            held, size = [], 0
                if seen != count:
                    raise ValueError(f"{path}: {seen} records, the manifest has {count}")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=out)

    import pyarrow as pa
    out = pa.schema([(n, pa.string() if n in ("payload_digest", "record_type") else pa.binary() if n == "payload" else pa.int64())
                     for n in names])
    files = manifest.sparkSession.sparkContext.defaultParallelism
    dealt = manifest.repartition(max(files, 64), "path")
    return dealt.mapInArrow(run, schema + (", payload binary" if with_payload else ""))
