import random
import re

import numpy as np

from tavola.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)) if words else 0,
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def texts():
    rng = random.Random(2)
    vocab = [f"word{i}é" for i in range(400)]
    good = [" ".join(rng.choice(vocab) for _ in range(rng.randint(60, 200))) + ".\nA line." for _ in range(120)]
    bad = [" ".join(rng.choice(vocab) + "###" for _ in range(rng.randint(60, 200))) for _ in range(30)]
    return good, bad


ODD = ["", None, " \n\t", "a", "a b c a b c", "a b c d a b c d e", "x\x1cy z\x85w  v", "one\n\none\none \n two\r\ntwo\r\n",
       "# * $ |\n# * $ |", "A A A A A", "word " * 50, "é" * 9000, "many different words " * 9000]


def test_counts_match_brute_force():
    for t in ODD + texts()[0][:10]:
        assert Q.text_counts(t)[:5] == brute(t), t


def test_judge_keeps_good_rejects_bad(spark):
    good, bad = texts()
    rows = [(i, t, "z") for i, t in enumerate(good + bad + ODD)] + [(None, good[0], "z"), (3, good[3], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    labels = spark.createDataFrame([(i, 1 if i < len(good) else 0) for i in range(0, len(good) + len(bad), 2)]
                                   + [(None, 1), (1, None), (99999, 0), (2, 1)], "doc_id long, quality int")
    got = Q.judge_documents(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None or r.doc_id < len(good):
            assert r.kept and not r.base_failed
        else:
            assert not r.kept
        text = rows[r.doc_id][1] if r.doc_id is not None else good[0]
        want = brute(text)
        assert tuple(r[1:6]) == want and r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    kept = Q.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted([*range(len(good)), -1, 3])


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "w " * 10), (2, " ".join(map(str, range(99))))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r.doc_id, r.kept) for r in Q.judge_documents(docs, labels).collect()) == [(1, False), (2, True)]
    assert Q.judge_documents(docs.limit(0), labels).collect() == []
    assert Q.kept_documents(docs.limit(0), labels).collect() == []


def test_limit_takes_the_middle_of_the_best_range():
    assert Q.pick_limit({2: 10}, {6: 5}, 0.0, 10) == (3 + 6) / 2 / 10
    assert Q.pick_limit({2: 10}, {}, 0.0, 10) == (3 + 10) / 2 / 10
    assert Q.pick_limit({9: 10}, {1: 5}, 0.0, 10) == 1.0


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    f = Q.grow_forest(x)
    assert f.score(np.full((1, 5), 8.0))[0] > np.quantile(f.score(x), 0.999)


def test_path_lengths_match_a_plain_forest():
    """Scores against path lengths followed node by node, and the trees against the rows that grew them."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(60, 3)), [[9, 9, 9]]])
    forest = Q.grow_forest(x[:60], trees=7, rows=20, seed=3)
    seen = np.vstack([x, x[:3] + 1e-9])

    def mean_unsuccessful(n):   # by its definition from harmonic numbers, as the logarithm approximates them
        return 0 if n < 2 else 1 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def path(tree, row):
        at, depth = 0, 0
        while forest.left[tree, at] != at:
            at = forest.left[tree, at] if row[forest.feature[tree, at]] < forest.split[tree, at] else forest.right[tree, at]
            depth += 1
        return depth, forest.length[tree, at]

    want = []
    for row in seen:
        lengths = [path(t, row) for t in range(7)]
        assert all(h >= d for d, h in lengths)   # a leaf of several rows adds what a search among them would
        want.append(2 ** (-np.mean([h for _, h in lengths]) / mean_unsuccessful(20)))
    assert np.allclose(forest.score(seen), want)
    assert np.argmax(forest.score(x)) == 60
    assert Q.unsuccessful(1) == 0 and Q.unsuccessful(2) == 1 and abs(Q.unsuccessful(256) - mean_unsuccessful(256)) < 1e-12
