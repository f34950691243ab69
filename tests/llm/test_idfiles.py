import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tavola.llm import idcodec, idfiles

WORD = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65534) | st.integers(0, 5), max_size=60), max_size=12))
def test_codec_round_trip(lists):
    documents = [np.array(x, np.int64) for x in lists]
    names = [None if k % 5 == 4 else k * 10 ** 15 for k in range(len(documents))]
    got_names, got = idcodec.decode_file(idcodec.encode_file(names, documents))
    assert got_names == names and [g.tolist() for g in got] == lists


def test_codec_on_long_skewed_and_constant_ids():
    rng = np.random.default_rng(1)
    for ids in (np.full(3 * idcodec.BLOCK + 5, 7), rng.zipf(1.3, 20000) % 60000, np.tile(rng.integers(0, 65535, 300), 60),
                np.arange(65535), np.zeros(1, int)):
        data = idcodec.encode_file([1], [ids])
        assert (idcodec.decode_file(data)[1][0] == ids).all()
    assert len(idcodec.encode_file([1], [np.tile(rng.integers(0, 65535, 300), 60)])) < 60 * 300 * 2 / 4


def test_more_blocks_than_lanes(monkeypatch):
    monkeypatch.setattr(idcodec, "BLOCK", 50)
    monkeypatch.setattr(idcodec, "LANES", 7)
    ids = np.random.default_rng(2).integers(0, 900, 1234)
    assert (idcodec.decode_file(idcodec.encode_file([1], [ids]))[1][0] == ids).all()


def test_blocks_are_independent_and_checked():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.4, 3 * idcodec.BLOCK) % 5000
    prior = idcodec.Prior.counted(ids)
    blocks = [ids[i:i + idcodec.BLOCK] for i in range(0, len(ids), idcodec.BLOCK)]
    coded = idcodec.encode_blocks(blocks, prior)
    assert (idcodec.decode_blocks(coded[1:2], [idcodec.BLOCK], prior)[0] == blocks[1]).all()
    data = bytearray(idcodec.encode_file([1], [ids]))
    for at in (len(data) - 40, len(data) // 2, 30):
        bad = bytearray(data)
        bad[at] ^= 0x55
        with pytest.raises(Exception):
            idcodec.decode_file(bytes(bad))
    with pytest.raises(ValueError):
        idcodec.encode_file([1], [np.array([65535])])


def test_files_give_back_documents_in_order(spark, monkeypatch):
    monkeypatch.setattr(idfiles, "RANGE_BYTES", 2000)
    texts = ["", None, "One two <|endoftext|>", "long text " * 3000, "é 你好 \x1c", "same"]
    rows = [(k * 7 % 101, texts[k % 6], "x", 1) for k in range(101)] + [(None, "b", "", 2), (None, None, "", 2), (4, "again", "", 2), (4, "again", "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string, start int").repartition(5)
    got = sorted(idfiles.read_documents(idfiles.write_documents(df, WORD), with_ids=True).collect(), key=lambda r: r.start)
    tok, at = Tokenizer.from_file(WORD), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert len(got) == len(order)
    for r, (name, text, *_) in zip(got, order):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (name, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert idfiles.read_documents(idfiles.write_documents(empty, WORD)).collect() == []
