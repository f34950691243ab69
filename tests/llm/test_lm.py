import math
import random
import re
from collections import Counter

import pytest

from tavola.llm import lm


def toks(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def brute(train, texts):
    """Interpolated modified Kneser-Ney from its textbook formulas."""
    uni, pairs = Counter(), Counter()
    for t in train:
        w = toks(t)
        uni.update(w)
        pairs.update(zip(["</s>", *w], w))
    n, v = sum(uni.values()), len(uni)
    before, after = Counter(), {}
    for (a, b), c in pairs.items():
        before[b] += 1
        after.setdefault(a, []).append(c)

    def disc(counts):
        k = [sum(c == i for c in counts) for i in (1, 2, 3, 4)]
        return lm.discounts(*k)
    d2, d1 = disc(list(pairs.values())), disc(list(before.values()))
    cut = lambda c, d: 0 if c == 0 else d[min(c, 3) - 1]
    out = []
    for t in texts:
        base = total = 0.0
        prev = "</s>"
        for w in toks(t):
            base += math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1)))
            if pairs:
                rest = sum(cut(c, d1) for c in before.values()) / len(pairs)
                p = max(before[w] - cut(before[w], d1), 0) / len(pairs) + rest / (v + 1)
            else:
                p = 1 / (v + 1)
            if prev in after:
                s = sum(after[prev])
                c = pairs[prev, w]
                p = max(c - cut(c, d2), 0) / s + sum(cut(x, d2) for x in after[prev]) / s * p
            total += math.log10(p)
            prev = w
        out.append((len(toks(t)), sum(uni[w] > 0 for w in toks(t)), base, total))
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    vocab = [f"W{i}é" for i in range(60)]
    texts = [" ".join(rng.choice(vocab[:rng.randint(1, 60)]) for _ in range(rng.randint(0, 80))) for _ in range(80)]
    return texts + [None, "", " \n", "A a A a", "unseen words only here", "w1É W1é", "x " * 3000]


def run(spark, train, texts):
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, score double")
    model = lm.train(spark.createDataFrame([(t,) for t in train], "text string"))
    return [tuple(r)[1:5] for r in sorted(lm.score(df, model).collect(), key=lambda r: r.doc_id)], model


def test_scores_match_the_formulas(spark):
    texts = corpus()
    train = texts[:60] + texts[-7:-4]
    got, model = run(spark, train, texts)
    want = brute(train, texts)
    assert model.train_tokens == sum(len(toks(t)) for t in train)
    for g, w in zip(got, want):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9) and g[3] == pytest.approx(w[3], rel=1e-9)
    assert len(got) == len(texts)


def test_many_shards_and_split_words(spark, monkeypatch):
    # Shard counts are fixed when the jobs are built; SPLIT and GATHER are read inside tasks from the module.
    monkeypatch.setattr(lm, "WORD_SHARD_BYTES", 700)
    monkeypatch.setattr(lm, "PAIR_SHARD_BYTES", 300)
    texts = corpus(9)
    got, model = run(spark, texts, texts)
    assert len(model.lexicon.sizes) > 5 and model.pair_shards > 10
    for g, w in zip(got, brute(texts, texts)):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-9) and g[3] == pytest.approx(w[3], rel=1e-9)


def test_pair_shards_split_common_words():
    import numpy as np
    second = np.arange(5000)
    first = np.full(5000, 7)
    one = lm.pair_shard(first, second, np.full(5000, 10), 50)
    many = lm.pair_shard(first, second, np.full(5000, 40 * lm.SPLIT), 50)
    assert len(set(one)) == 1 and len(set(many)) > 20
    assert (many == lm.pair_shard(first, second, np.full(5000, 40 * lm.SPLIT), 50)).all()


def test_probabilities_sum_to_one(spark):
    train = ["a b c a b", "b c d d", "a a b"]
    vocab = ["a", "b", "c", "d"]
    got, _ = run(spark, train, [f"a {w}" for w in [*vocab, "zzz"]] + ["a"])
    first = brute(train, ["a"])[0][3]
    ends = {w: brute(train, [f"a {w}"])[0][3] for w in vocab}
    assert all(math.isfinite(v) for v in ends.values()) and math.isfinite(first)
    assert all(g[3] == pytest.approx(w[3]) for g, w in zip(got, brute(train, [f"a {w}" for w in [*vocab, "zzz"]] + ["a"])))


def test_empty_training_and_empty_input(spark):
    got, model = run(spark, [], ["a b", None])
    assert model.train_tokens == 0 and got == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    model = lm.train(spark.createDataFrame([("a b",)], "text string"))
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), model).collect() == []


def test_null_ids_repeated_rows_and_clashing_names(spark):
    model = lm.train(spark.createDataFrame([("a b c",), (None,)], "text string"))
    rows = [(None, "a b", 1.0), (None, None, 2.0), (4, "a b", 3.0), (4, "a b", 3.0), (5, "", 4.0)]
    got = [tuple(r) for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, perplexity double"), model).collect()]
    assert sorted(map(str, (r[0] for r in got))) == ["4", "4", "5", "None", "None"]
    by_text = {"a b": [r[1:] for r in got if r[1] == 3], "end": [r[1:] for r in got if r[1] == 1]}
    assert len(by_text["a b"]) == 3 and len(set(by_text["a b"])) == 1 and len(by_text["end"]) == 2 and len(set(by_text["end"])) == 1


def test_open_arrays_are_bounded(monkeypatch):
    monkeypatch.setattr(lm, "OPEN", 3)
    loaded = []
    arrays = lm.Open(lambda s: loaded.append(s) or s * 10)
    assert [arrays[s] for s in (1, 2, 3, 1, 4, 1, 2, 2)] == [10, 20, 30, 10, 40, 10, 20, 20]
    assert loaded == [1, 2, 3, 4, 2] and sorted(arrays) == [1, 2, 4]


def brute_three(train, texts):
    """Order three from the textbook formulas: continuation counts below the top."""
    uni, triples, end = Counter(), Counter(), "</s>"
    for t in train:
        w = toks(t)
        uni.update(w)
        triples.update(zip([end, end, *w], [end, *w], w))
    two = Counter((b, c) for _, b, c in triples)
    one = Counter(c for _, c in two)
    disc = lambda counts: lm.discounts(*[sum(c == i for c in counts) for i in (1, 2, 3, 4)])
    d3, d2, d1 = (disc(list(x.values())) for x in (triples, two, one))
    cut = lambda c, d: 0 if c == 0 else d[min(c, 3) - 1]
    after_two, after_one = {}, {}
    for (a, b, _), c in triples.items():
        after_two.setdefault((a, b), []).append(c)
    for (b, _), c in two.items():
        after_one.setdefault(b, []).append(c)

    def level(c, d, after, lower):
        return max(c - cut(c, d), 0) / sum(after) + sum(cut(x, d) for x in after) / sum(after) * lower
    out = []
    for t in texts:
        total, a, b = 0.0, end, end
        for w in toks(t):
            p = max(one[w] - cut(one[w], d1), 0) / len(two) + sum(cut(c, d1) for c in one.values()) / len(two) / (len(uni) + 1)
            if b in after_one:
                p = level(two[b, w], d2, after_one[b], p)
            if (a, b) in after_two:
                p = level(triples[a, b, w], d3, after_two[a, b], p)
            total += math.log10(p)
            a, b = b, w
        out.append(total)
    return out


@pytest.mark.parametrize("small", [False, True])
def test_order_three_matches_the_formulas(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(lm, "WORD_SHARD_BYTES", 700)
        monkeypatch.setattr(lm, "PAIR_SHARD_BYTES", 300)
    texts = corpus(6)
    train = texts[:60] + texts[-7:-4] + texts[:9]
    model = lm.train(spark.createDataFrame([(t,) for t in train], "text string").repartition(3), order=3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.score for r in sorted(lm.score(df, model).collect(), key=lambda r: r.doc_id)]
    assert model.order == 3 and (model.pair_shards > 10) == small
    for g, w in zip(got, brute_three(train, texts), strict=True):
        assert g == pytest.approx(w, rel=1e-9)


def test_order_three_without_texts_and_other_orders(spark):
    empty = spark.createDataFrame([], "text string")
    model = lm.train(empty, order=3)
    assert [r.score for r in lm.score(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model).collect()] == [0.0]
    with pytest.raises(ValueError):
        lm.train(empty, order=4)


def test_triple_shards_split_common_contexts():
    import numpy as np
    third, context = np.arange(5000), lm.chain(np.full(5000, 7), np.full(5000, 8))
    assert len(set(lm.triple_shard(context, third, np.full(5000, 10), 50))) == 1
    assert len(set(lm.triple_shard(context, third, np.full(5000, 40 * lm.SPLIT), 50))) > 20
