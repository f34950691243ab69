from collections import Counter
import hashlib
import random
import re

import pytest

from tavola.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute(rows, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by capping and resharing step by step; documents by their hashes in order."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, free = share * sum(sizes.values()), [s for s in names]
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum(max(0, target[s] - cap * sizes[s]) for s in free)
        for s in free:
            target[s] = min(target[s], cap * sizes[s])
        free = [s for s in free if target[s] < cap * sizes[s] - 1e-9]
    out = {}
    for s in names:
        hashed = {}
        for i, (doc, source, text) in enumerate(rows):
            if source == s:
                h = int(hashlib.md5(("" if doc is None else str(doc)).encode()).hexdigest()[:15], 16)
                hashed.setdefault(h, []).append(i)
        whole = int((target[s] + 1e-9) // sizes[s]) if sizes[s] else 0
        rest, cum, open_ = target[s] - whole * sizes[s], 0, True
        for h in sorted(hashed):
            n = sum(size(rows[i][2]) for i in hashed[h])
            take = cum + n <= rest + 1e-9 or open_ and cum + n - rest < rest - cum
            open_ = open_ and cum + n <= rest + 1e-9
            cum += n
            for i in hashed[h]:
                out[i] = (size(rows[i][2]), sizes[s], target[s], size(rows[i][2]) * (whole + take))
    return out


def corpus(seed=0, n=300, sources=("a", "b", "c", "é", "z", None)):
    rng = random.Random(seed)
    rows = [(i, rng.choice(sources[:1] * 6 + sources), "w " * rng.choice([0, 1, 5, 40, 300])) for i in range(n)]
    return rows + [(n, "empty", ""), (n + 1, "empty", None), (n + 2, "one", "x " * 5000), (None, "a", "no id"), (3, rows[3][1], rows[3][2])]


@pytest.mark.parametrize("seed", [0, 1])
def test_mix_matches_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id long, source string, text string, _key string, target double")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r["size"], r.source_size, round(r.target, 6), r.taken) for r in mixing.mix(df).collect())
    want = brute(rows)
    assert got == sorted(((rows[i][0] is None, rows[i][0] or 0), a, b, round(t, 6), k) for i, (a, b, t, k) in want.items())
    for source in {r[1] for r in rows}:
        mine = [v for i, v in want.items() if rows[i][1] == source]
        assert abs(sum(v[3] for v in mine) - mine[0][2]) <= max(v[0] for v in mine)


def test_documents_are_repeated_as_taken(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got, want = {}, {}
    for r in out.collect():
        key = (r.doc_id, r.source, r.text)
        got[key] = got.get(key, 0) + size(r.text)
    for i, (_, _, _, taken) in brute(rows).items():
        want[rows[i]] = want.get(rows[i], 0) + taken
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_no_rows_and_no_words(spark):
    schema = "doc_id long, source string, text string"
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, None, None), (2, "a", " ")], schema)).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_empty_texts_come_at_most_cap_times(spark):
    """A source whose whole copies meet its target has no threshold: nothing is taken once more."""
    rows = [(i, "a", "one two three" if i % 2 else ["", None][i % 4 // 2]) for i in range(80)] + [(100 + i, "b", "word " * 50) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed = [(r.doc_id, r.taken, r.copies, r.size, r.target, r.source_size) for r in mixing.mix(df).collect() if r.doc_id < 100]
    assert all(r[4] == 2 * r[5] and r[2] == 2 and r[1] == 2 * r[3] for r in mixed)
    times = Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    assert {times[i] for i in range(80)} == {2}


def test_mix_of_an_empty_table_and_clashing_names(spark):
    schema = "doc_id long, source string, text string, _doc string, _n int, _key string, copies int"
    assert mixing.mixed_documents(spark.createDataFrame([], schema)).collect() == []
    rows = [(i % 5 or None, None if i % 3 else "s", "a b c", "d", i, "k", 9) for i in range(30)]
    got = mixing.mixed_documents(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "source", "text", "_doc", "_n", "_key", "copies"] and set(map(tuple, got.collect())) <= set(rows)
