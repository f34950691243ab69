import base64
import hashlib
import io

import pytest

from tavola.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def brute(rows, min_bytes=0):
    best = {}
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        if page is not None:
            best[p] = max(best.get(p, page), page)
    out = []
    for page, _, html, *_ in rows:
        p = (html or "").encode()
        again = len(p) >= min_bytes and page != best.get(p)
        out.append((page, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response",
                    best.get(p) if again else None))
    return sorted(out, key=str)


ROWS = [(i, f"http://a.example/{i}", "<html>" + "abc é " * (i % 7) + "</html>", "x") for i in range(60)] + [
    (100, None, None, "x"), (101, "u\r\nInjected: y", "", None), (102, "u é", "long " * 60000, "x"), (None, "n", "alone", "x"),
    (None, "n", "", "x"), (103, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n", "x"), (5, "again", "other text", "x")]


@pytest.mark.parametrize("min_bytes", [0, 20])
def test_archives_give_back_every_record(spark, tmp_out, min_bytes):
    df = spark.createDataFrame(ROWS, SCHEMA)
    manifest = warc.write_archives(df, min_bytes=min_bytes, uri=f"file://{tmp_out}/w")
    got = warc.read_archives(manifest, with_payload=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(ROWS, min_bytes)
    stored = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    want = {warc.digest((h or "").encode()): (h or "").encode() for _, _, h, _ in ROWS}
    assert stored == want


def test_repeated_rows_are_both_stored_and_empty_table(spark, tmp_out):
    rows = [(1, "u", "same", ""), (1, "u", "same", ""), (0, "u", "same", "")]
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, SCHEMA), uri=f"file://{tmp_out}/r")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in got) == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    none = warc.write_archives(spark.createDataFrame([], SCHEMA), uri=f"file://{tmp_out}/e")
    assert none.count() == 0 and warc.read_archives(none).collect() == []


def test_records_are_single_frames_with_a_leading_dictionary():
    records = [warc.record_bytes(i, "u", b"text %d " % i * 50) for i in range(200)]
    dictionary = warc.build_dictionary(records)
    frames = list(warc.archive_frames(dictionary, records))
    assert len(frames) == 201 and frames[0][:4] == b"\x5d\x2a\x4d\x18" and frames[0][8:] == dictionary
    plain = sum(map(len, warc.archive_frames(b"", records)))
    assert sum(map(len, frames[1:])) < plain
    assert list(warc.archive_records(io.BytesIO(b"".join(frames)))) == records
    for broken in (b"".join(frames)[:-3], b"".join(frames[1:])):
        with pytest.raises(Exception):
            list(warc.archive_records(io.BytesIO(broken)))
    with pytest.raises(ValueError):
        warc.parse_record(records[0].replace(b"text 0", b"text 1", 1))
