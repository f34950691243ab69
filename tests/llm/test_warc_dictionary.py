import random
import struct

from tavola.llm import warc


def test_large_pages_train_a_dictionary_too(spark, tmp_out):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(400)]
    rows = [(i, f"u{i}", " ".join(rng.choices(words, k=warc.SAMPLE_RECORD_BYTES // 6))) for i in range(24)]
    assert all(len(html) > warc.SAMPLE_RECORD_BYTES for *_, html in rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(df, uri=f"file://{tmp_out}/l")
    for r in manifest.collect():
        with open(r.path.removeprefix("file://"), "rb") as f:
            magic, size = struct.unpack("<II", f.read(8))
            dictionary = f.read(size)
        assert magic == warc.SKIPPABLE and size > 0 and any(w.encode() in dictionary for w in words)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read_archives(manifest, with_payload=True).collect()}
    assert got == {i: html for i, _, html in rows}
