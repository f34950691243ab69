import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tavola.llm import packing, tokens

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, "a  b", " a", "a ", "\n\n x \n y", "a\tb c", "x<|endoftext|>y z", "É é́ Ab'S 12 3", "a b c", "a\x1cb",
       "\x1fa b", "...  !!! it's I'LL we've", "你好  世界", "A\nB C\n D", "İstanbul ΣΑΣ", " ́x", "\n", "  ", "x" * 5000,
       "many words here " * 3000]


def test_encoder_equals_the_library():
    for path in (BYTE, WORD):
        tok, enc = Tokenizer.from_file(path), tokens.Encoder(path)
        for texts in (ODD, list(reversed(ODD))):
            ids, at = enc.encode(texts)
            for k, t in enumerate(texts):
                assert ids[at[k]:at[k + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB'sÉ1 \n\t.,́ 你<|\x1f\x85"), max_size=40))
def test_encoder_on_random_texts(text):
    for path in (BYTE, WORD):
        ids, _ = tokens.encoder(path).encode([text])
        assert ids.tolist() == tokens.encoder(path).tok.encode(text, add_special_tokens=False).ids


def test_encoder_cache_limit(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 50)
    enc = tokens.Encoder(BYTE)
    texts = [" ".join(f"w{i * j}" for j in range(30)) for i in range(20)]
    ids, at = enc.encode(texts)
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids
    assert len(enc.index) <= 80


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=20))
def test_best_fit_places_every_piece_once(counts):
    plan = packing.best_fit(dict(counts), 32)
    used = {}
    for many, contents in plan:
        assert many > 0 and sum(n * k for n, k in contents) <= 32
        for n, k in contents:
            used[n] = used.get(n, 0) + many * k
    assert used == counts
    rooms = []
    for n in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):   # one piece at a time
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
        rooms.append((min(fits) if fits else 32) - n)
    assert sum(m for m, _ in plan) == len(rooms)


def packed_rows(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, length string, offset string")
    return packing.pack_documents(df, BYTE, **kw).collect()


def check(rows, got, max_len):
    tok = Tokenizer.from_file(BYTE)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= max_len
    for doc_id, text, *_ in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id])
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert sum(p[2] for p in pieces) == len(ids) and all(p[2] == max_len for p in pieces[1:])
        at = 0
        for _, start, length, crc in pieces:
            assert start == at and crc == zlib.crc32(ids[at:at + length].tobytes())
            at += length
    return len(by_seq)


def test_pieces_and_places(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(ODD)] + [(100 + i, "same length words" * (i % 4 + 1), None, None) for i in range(60)]
    got = packed_rows(spark, rows, max_len=64)
    n = check(rows, got, 64)
    assert n <= 1.1 * sum(r.length for r in got) / 64 + 2


def test_salted_ranks_give_every_piece_its_own_place(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_SALT", 7)
    rows = [(i, "three equal words", None, None) for i in range(100)]
    check(rows, packed_rows(spark, rows, max_len=16), 16)


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(None, "a b", None, None), (None, "a b", None, None), (5, "c", None, None), (5, "c", None, None)]
    got = packed_rows(spark, rows, max_len=8)
    assert len(got) == 4
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for s in spans.values():
        s.sort()
        assert all(a[1] == b[0] for a, b in zip(s, s[1:])) and s[0][0] == 0
    assert packed_rows(spark, []) == []


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, None)], "doc_id long, text string")
    packed = packing.pack(packing.tokenized_pieces(df, BYTE, max_len=8, with_ids=True), 8)
    tok = Tokenizer.from_file(BYTE)
    total = sorted(i for r in packing.sequences(packed).collect() for i in r.ids)
    assert total == sorted(i for t in ("one two three", "four", "") for i in [*tok.encode(t).ids, 0])


def test_word_vocabulary_learns_each_word_once():
    """Pieces are cut where the pre-tokenizer cuts, so a word is learned once whatever stands around it."""
    enc = tokens.Encoder(WORD)
    texts = ["Größe größe, größe,$$$ größe!! (größe) größe7 größe77.", "it's it's. größe² x.y z.", "".join(map(chr, range(256)))] * 2
    ids, at = enc.encode(texts)
    for k, t in enumerate(texts):
        assert ids[at[k]:at[k + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids
    assert [p for p in enc.index if "größe" in p] == ["größe"]
    assert {"it's", ".", ",$$$", "7", "²"} <= set(enc.index)
