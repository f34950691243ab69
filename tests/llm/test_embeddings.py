import math

import numpy as np
import pytest

from tavola.llm import embeddings


def brute(rows, min_cosine=0.98):
    n = len(rows)
    ok = [v is not None and lab is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v, lab, *_ in rows]
    links, label = [0] * n, list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float32).astype(float) for k in (i, j))
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= min_cosine:
                    links[i] += 1
                    links[j] += 1
                    label[find(i)] = find(j)
    first = {}
    for i in range(n):
        first[find(i)] = min(first.get(find(i), math.inf), rows[i][0])
    return sorted((rows[i][0], links[i], first[find(i)], rows[i][0] == first[find(i)]) for i in range(n))


def make(seed=3, groups=12, dim=24):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 14))):
            v = base + rng.normal(size=dim) * 0.14 * rng.integers(0, 2) * np.linalg.norm(base) / math.sqrt(dim)
            rows.append((k, [float(np.float32(x)) for x in v], int(g % 3), "x"))
            k += 1
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, cls string"


@pytest.mark.parametrize("chunk", [1024, 3])
def test_links_components_and_kept(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    rows = make()
    v = rows[0][1]
    rows += [(500, v, None, "x"), (501, v, 0, "x"), (502, [2 * x for x in v], 0, "x"), (503, v, 1, "x"), (504, None, 0, "x"),
             (505, [0.0] * 24, 0, "x"), (506, [], 0, "x"), (507, [None] + v[1:], 0, "x"), (508, [math.nan] + v[1:], 0, "x"),
             (509, [math.inf] + v[1:], 0, "x"), (510, [0.0] * 24, 0, "x"), (511, [1.0, 1.0], 0, "x"), (512, [1.0, 1.01], 0, "x")]
    got = sorted(tuple(r) for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_empty_null_ids_and_repeats(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(None, [1.0, 2.0], 1, ""), (4, [1.0, 2.0], 1, ""), (4, [1.0, 2.0], 1, ""), (None, [5.0, -1.0], 2, "")]
    got = sorted(((r.vec_id or -1), r.n_links, r.component_id, r.kept) for r in
                 embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 0, None, True), (-1, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True)]


def test_hashing_finds_nearly_all_pairs_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    e = rng.normal(size=a.shape)
    e -= (e * a).sum(1, keepdims=True) * a
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * e
    x, y = embeddings.bucket_codes(a), embeddings.bucket_codes(b)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() > 0.999


def test_hadamard_is_orthogonal():
    h = embeddings.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, 16 * np.eye(16))
