import tracemalloc

import numpy as np
import public_tokenizers

from tavola.llm import idcodec
from tavola.llm.tokens import Encoder


def test_contexts_of_a_block_fit_the_tables():
    """900 contexts come back in every block; tables of 1,024 slots lose many of them to each other."""
    rng = np.random.default_rng(11)
    ids = np.tile(rng.integers(0, 60000, 900), 60)
    data = idcodec.encode_file([1], [ids])
    assert (idcodec.decode_file(data)[1][0] == ids).all()
    assert len(data) / len(ids) < 0.72   # 0.803 with 1,024 slots, 0.662 with 4,096


def test_frequencies_lag_behind_no_step_and_targets_find_their_group():
    """Groups seen are counted at every rebuild; the decoder's guess is never past the group that holds a target."""
    rng = np.random.default_rng(12)
    prior = idcodec.Prior.counted(rng.zipf(1.2, 30000) % 4000)
    lanes = idcodec.Lanes(300, prior, 64, guess=True)
    groups = rng.integers(0, prior.groups, (64, 300))
    for step in range(64):
        lanes.predict()
        ids = np.full(300, step, np.uint32)
        lanes.update(ids, groups[step], lanes.s2 == ids, lanes.s1 == ids)
    want = np.tile((prior.mass >> 6) + 1, (300, 1)).astype(float)
    for row in groups:
        want[np.arange(300), row] += idcodec.COUNT_STEP
    assert (lanes.counts == want).all()
    starts = lanes.spans >> 15
    assert ((lanes.spans & 0x7FFF).sum(1) == 1 << idcodec.MIX_BITS).all()
    targets = np.arange(lanes.guesses.shape[1] - 1) << idcodec.BUCKET_BITS
    for k in (0, 7, 299):
        assert (lanes.guesses[k, :-1] == np.searchsorted(starts[k], targets, "right") - 1).all()


def test_carries_reach_the_words_written():
    """Many lanes of rare ids and long blocks: carries go through words written long before."""
    rng = np.random.default_rng(13)
    ids = rng.integers(0, 60000, 200 * idcodec.BLOCK)
    assert (idcodec.decode_file(idcodec.encode_file([1], [ids]))[1][0] == ids).all()


def peak_mb(work):
    tracemalloc.start()
    try:
        result = work()
        return result, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_file_with_many_blocks(monkeypatch):
    """The tables of one group of lanes are held at a time, and ids take two bytes."""
    monkeypatch.setattr(idcodec, "BLOCK", 8)
    ids = np.arange(8 * 8192) % 5000
    data, wrote = peak_mb(lambda: idcodec.encode_file([1], [ids]))
    (_, (got,)), read = peak_mb(lambda: idcodec.decode_file(data))
    assert (got == ids).all()
    assert got.itemsize == 2
    assert wrote < 200 and read < 200   # MB; with 8,192 lanes at once 308


def test_memory_of_cutting_texts():
    """8 MB of texts are cut in pieces of WORD_BYTES."""
    enc = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one word, two words; 12 of them. " * 32 for _ in range(8000)]
    (ids, at), peak = peak_mb(lambda: enc.encode(texts))
    assert (ids[:at[1]] == enc.encode(texts[:1])[0]).all() and len(ids) == 8000 * at[1]
    assert peak < 100   # MB
