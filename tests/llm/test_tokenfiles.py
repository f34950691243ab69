import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tavola.llm import tokenfiles as tf

BYTE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["one two", None, "", "<|endoftext|> as text", "many words " * 5000, "é 你好", "\n", "x"] + [f"document {i} " * (i % 9) for i in range(70)]


@pytest.mark.parametrize("block", [8, 1000, 4 << 20])
def test_counts_match_the_library(spark, block):
    tok = Tokenizer.from_file(BYTE)
    tok.encode_special_tokens = True
    texts = TEXTS if block > 8 else [t for t in TEXTS if len(t or "") < 999]
    rows = [(i, t, "a", 1) for i, t in enumerate(texts)] + [(0, texts[0], "b", 2), (None, "no id", "c", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string, place int").repartition(3)
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens) for r in tf.token_counts(df, BYTE, 50256, block_bytes=block).collect())
    want = sorted(((i is None, i or 0), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in rows)
    assert got == want


def test_scan_of_given_files(spark, tmp_out):
    rng = np.random.default_rng(0)
    files, want = [], []
    for k in range(6):
        ids = rng.integers(0, 4, 1 + k * 37).astype("<u4") if k else np.empty(0, "<u4")
        path = f"{tmp_out}/f{k}.ids"
        ids.tofile(path)
        files.append((path, ids.nbytes))
        at = np.flatnonzero(ids == 0)
        lengths = (np.diff(np.append(-1, at)) - 1).tolist()
        rest = len(ids) - (at[-1] + 1 if len(at) else 0)
        want += [(path, i, n) for i, n in enumerate(lengths + ([rest] if rest else []))]
    df = spark.createDataFrame([(f"file://{p}", n) for p, n in files], "path string, bytes long")
    got = [(r.path.removeprefix("file://"), r.place, r.n_tokens) for r in tf.document_lengths(df, 0, "<u4", 16).collect()]
    assert sorted(got) == sorted(want)


def test_empty_table(spark):
    assert tf.token_counts(spark.createDataFrame([], "doc_id long, text string"), BYTE, 50256).collect() == []
