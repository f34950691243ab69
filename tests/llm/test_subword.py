import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tavola.llm import subword as S

ODD = [None, "", " \n\t", "a", "a a a b", "é 语 😀 naïve", "<x> ><", "x\x1cy z\x85w  v", "word " * 3000, "z" * 5000, "1,2;3 !!"]
MASK = (1 << 64) - 1


def bucket(h, kind):
    m = (h + kind) * S.MIX[1] & MASK
    return ((m ^ m >> 29) * S.MIX[0] & MASK) >> 40 & (S.BUCKETS - 1)


def brute_features(text):
    """Counts by bucket, n-gram by n-gram."""
    words, found = [w.decode() for w in (text or "").encode().split()], Counter()
    for w in words:
        found[bucket(zlib.crc32(w.encode()), 1)] += 1
        marked = f"<{w}>"
        for n in (3, 4, 5):
            for k in range(len(marked) - n + 1):
                h = 0
                for c in marked[k:k + n]:
                    h = (h * S.MIX[0] + ord(c)) & MASK
                found[bucket(h, n)] += 1
    for a, b in zip(words, words[1:]):
        pair = (zlib.crc32(a.encode()) * S.MIX[0] & MASK) ^ zlib.crc32(b.encode())
        found[0 if a == b else bucket(pair, 2)] += 1
    return dict(found)


def corpus(n=60):
    rng = random.Random(4)
    vocab = [f"wörd{i}" for i in range(300)]
    good = [" ".join(rng.choice(vocab) for _ in range(rng.randint(20, 90))) for _ in range(n)]
    bad = [" ".join(rng.choice(vocab) + rng.choice(["##", "%%"]) for _ in range(rng.randint(20, 90))) for _ in range(n // 3)]
    bad += [" ".join([rng.choice(vocab)] * 60) for _ in range(n // 3)]
    return good, bad


def test_features_match_brute_force():
    for t in ODD + sum(corpus(9), []):
        found, counts = S.document_features(t)
        assert dict(zip(found.tolist(), counts.tolist())) == brute_features(t)
        assert len(set(found.tolist())) == len(found)


def test_gradient_matches_differences():
    """One step of training is the gradient of the row's cross entropy times the step length."""
    rng = np.random.default_rng(0)
    row, rate, eps = (np.array([1, 5, 7]), np.array([2, 1, 3]), 1), 1e-3, 1e-6
    before = S.train([], buckets=8, dim=3)
    layer = rng.normal(size=(3, 2))

    def loss(vectors):
        return -np.log(S.Model(vectors, layer, np.zeros(2)).probabilities(row[0], row[1])[1])

    want = np.zeros_like(before.vectors)
    for k in np.ndindex(want.shape):
        moved = before.vectors.copy()
        moved[k] += eps
        want[k] = (loss(moved) - loss(before.vectors)) / eps
    error = S.Model(before.vectors, layer, np.zeros(2)).probabilities(row[0], row[1]) - np.array([0, 1])
    got = np.zeros_like(want)
    got[row[0]] = np.outer(row[1] / 6, layer @ error)
    assert np.allclose(got, want, atol=1e-5)
    trained = S.train([row], buckets=8, dim=3, epochs=1, rate=rate)   # the layer starts at zero: only it and the bias move
    mean = row[1] / 6 @ before.vectors[row[0]]
    assert np.allclose(trained.layer, rate * np.outer(mean, [-.5, .5])) and np.allclose(trained.vectors, before.vectors)


def test_scorer_equals_the_model_text_by_text(monkeypatch):
    good, bad = corpus()
    model = S.train([(*S.document_features(t), k) for k, texts in ((0, bad), (1, good)) for t in texts], epochs=3)
    texts = ODD + good[:20] + bad[:20]
    want = [model.probabilities(*S.document_features(t)) for t in texts]
    scorer = S.Scorer(model.products, model.bias)
    assert np.allclose(scorer.probabilities(texts), want)
    monkeypatch.setattr(S, "MAX_WORDS", 5)   # the kept words start again
    for part in S._chunks(texts, 100):
        assert np.allclose(scorer.probabilities(part), [model.probabilities(*S.document_features(t)) for t in part])


def frames(spark, good, bad):
    texts = good + bad
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in enumerate(texts)] + [(None, "no id", "x", 2, "y"), (3, good[3], "z", 3, "y")]
                                 + [(1000 + k, t, "x", 0, "y") for k, t in enumerate(ODD)],
                                 "doc_id long, text string, _label string, quality int, _t string").repartition(4)
    labels = [(k, int(k < len(good)), 0) for k in range(len(texts)) if k % 4] + [(None, 1, 0), (7, None, 0), (99999, 0, 1), (9, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(spark):
    good, bad = corpus(120)
    docs, labels = frames(spark, good, bad)
    model = S.fit(docs, labels)
    got = [(r.doc_id, r.score) for r in S.score_documents(docs, model).collect()]
    assert len(got) == len(good) + len(bad) + 2 + len(ODD) and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    unseen = [k for k in range(len(good) + len(bad)) if k % 4 == 0]
    assert np.mean([(score[k] >= .3) == (k < len(good)) for k in unseen]) > .95
    assert score[1000] == score[1001] == score[1002]
    assert sorted(got, key=str) == sorted(((r.doc_id, r.score) for r in S.score_documents(docs.repartition(7), S.fit(docs, labels)).collect()),
                                          key=str)


def test_sample_is_bounded(spark, monkeypatch):
    good, bad = corpus(90)
    docs, labels = frames(spark, good, bad)
    seen = []
    monkeypatch.setattr(S, "train", lambda rows, **_: seen.append(rows))
    S.fit(docs, labels, rows_per_class=10)
    assert len(seen[0]) <= 20 and sum(r[2] for r in seen[0]) >= 8
    repeated = docs.unionByName(docs).unionByName(docs)
    S.fit(repeated, labels, rows_per_class=10)
    assert len(seen[1]) <= 20
    S.fit(docs, labels, rows_per_class=50, max_features=3000)
    assert sum(len(r[0]) for r in seen[2]) <= 3000


@pytest.mark.parametrize("labels,score", [([], .5), ([(1, 1), (2, 1)], .8), ([(1, 0)], 1 / 3), ([(None, 1), (5, None)], .5)])
def test_nothing_to_learn(spark, labels, score):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (2, "")], "doc_id long, text string")
    model = S.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [r.score for r in S.score_documents(docs, model).collect()] == [score] * 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = S.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert S.score_documents(docs, model).collect() == []
