import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tavola.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "one two", " ", "  lead", "trail ", "a\n\nb", "tab\tand\r\nmore", "<|endoftext|> <s> </s> <unk> <0x41>", "▁mark", "a▁ b", "\n", "x",
       "etc. and so on, then. End.", "².5 m². x", "it's 10,000.00 dollars", "é́ 你好 😀 ​ z", "\x00 nul \x00", "a" * 3000, "word. " * 800 + "end",
       "café. naïve, Über\nnew line. here", "1234567890 12", "x\x1cy\x85z\xa0w", "　wide　space"]


def tokens(text):
    """(ids of A, their bytes), (ids of B, their bytes) by the libraries alone; none where the bytes differ."""
    if not text:
        return ([], []), ([], [])
    tok, sp = libraries()
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    entry_a, entry_b = entries()
    bytes_a, bytes_b = [entry_a[i] for i in a], [entry_b[i] for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return ([], []), ([], [])
    return (a, bytes_a), (b, bytes_b)


_made = {}


def libraries():
    if "lib" not in _made:
        tok = Tokenizer.from_file(A)
        tok.encode_special_tokens = True
        _made["lib"] = tok, sentencepiece.SentencePieceProcessor(model_file=B)
    return _made["lib"]


def entries():
    if "entries" not in _made:
        tok, sp = libraries()
        shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        back = {chr(b): b for b in shown}
        back.update({chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))})
        a = {i: bytes(back[c] for c in e) for e, i in tok.get_vocab().items()}
        b = {}
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            b[i] = bytes.fromhex(p[3:5]) if sp.is_byte(i) else p.replace("▁", " ").encode()
        _made["entries"] = a, b
    return _made["entries"]


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(texts):
    """Rows of align_documents, token by token, and the overlapping pairs of each text."""
    rows, held, count = [], [], Counter()
    for t in texts:
        (a, pa), (b, pb) = tokens(t)
        sa, sb = spans(pa), spans(pb)
        over = [(i, j) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]] if len(a) < 700 else None
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [([i for i, (_, e) in zip(a, sa) if lo < e <= hi], [i for i, (_, e) in zip(b, sb) if lo < e <= hi])
                  for lo, hi in zip([0, *ends], ends)] if len(a) < 700 else None
        end_b = {e: j for j, (_, e) in enumerate(sb)}
        link = [(a[i], b[end_b[e]]) for i, (_, e) in enumerate(sa) if e in end_b]
        count.update(link)
        held.append((a, b, over, groups, link))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    for a, b, over, groups, link in held:
        text = None if groups is None else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((len(a), len(b), len(link), len(link), sum(count[p] == top[p[1]] for p in link), sum(count[p] for p in link),
                     None if text is None else hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return rows, held


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = ["th", "ing", "er", " ", " ", " ", ".", ",", "\n", "é", "ß", "A", "42", "  ", "'s", "<", "|", "²", "▁", "語", "\t", "!!", "-"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_encoder_equals_the_libraries():
    encoder = align.PairEncoder(A, B)
    assert encoder.cuts_hold
    texts = ODD + random_texts(3000, 1)
    a, b = encoder.pair(texts)
    for k, t in enumerate(texts):
        (want_a, _), (want_b, _) = tokens(t)
        assert a.ids[a.offsets[k]:a.offsets[k + 1]].tolist() == want_a, t
        assert b.ids[b.offsets[k]:b.offsets[k + 1]].tolist() == want_b, t


def test_bounded_cache_starts_again(monkeypatch):
    encoder = align.PairEncoder(A, B)
    monkeypatch.setattr(align, "MAX_PIECES", 3)
    for t in ["one two three four", "two five six. seven", "one"]:
        a, b = encoder.pair([t])
        assert (a.ids.tolist(), b.ids.tolist()) == (tokens(t)[0][0], tokens(t)[1][0])


def test_documents_match_brute_force(spark):
    texts = ODD + random_texts(200, 2)
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows + [(0, texts[0], "again", 2), (None, "no id here", "y", 3)],
                               "doc_id long, text string, links string, n_a int").repartition(3)
    got = align.align_documents(df, A, B).collect()
    want, _ = brute([*texts, texts[0], "no id here"])
    expected = [(k, *w) for k, w in zip([*range(len(texts)), 0, None], want)]
    place = lambda r: (r[0] is None, r[0] or 0)
    for g, w in zip(sorted(map(tuple, got), key=place), sorted(expected, key=place), strict=True):
        assert g[:7] == w[:7]
        assert w[7] is None or g[7] == w[7]


def test_overlaps_and_groups_match_brute_force(spark, monkeypatch):
    texts = ODD + random_texts(60, 3)
    monkeypatch.setattr(align, "CHUNK_CHARS", 50)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, body string").repartition(2)
    got = {r.id: r for r in align.alignments(df, A, B, id_col="id", text_col="body").collect()}
    _, held = brute(texts)
    assert len(got) == len(texts)
    for k, (a, b, over, groups, _) in enumerate(held):
        assert (list(got[k].a_ids), list(got[k].b_ids)) == (a, b)
        if over is not None:
            assert [(x.a, x.b) for x in got[k].overlaps] == over
            assert [(x.n_a, x.n_b) for x in got[k].groups] == [(len(x), len(y)) for x, y in groups]


def test_pairs_stay_within_the_bound(spark):
    texts = [t for t in ODD + random_texts(400, 4) if t]
    counted = align.pair_counts(align.links(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string"), A, B))
    entry_a, entry_b = entries()
    rows = counted.collect()
    assert rows
    for r in rows:
        x, y = entry_a[r.a], entry_b[r.b]
        assert x.endswith(y) or y.endswith(x)
    assert len(rows) <= align.pair_bound(list(entry_a.values()), list(entry_b.values())) < 2_000_000


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "")]])
def test_no_tokens(spark, rows):
    got = align.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert [tuple(r) for r in got] == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]
