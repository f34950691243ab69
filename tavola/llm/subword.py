"""Supervised subword embeddings: a document classifier over hashed word and character n-gram vectors.

A word's features are itself, the character n-grams of the word in angle
brackets, and its pair with the word before (or that it repeats it). Each is hashed to a bucket that
holds a learned vector. A document is the mean of its features' vectors;
a softmax over a linear layer gives its classes' probabilities. Vectors and
layer are trained together by stochastic gradient descent in numpy, a
document at a time, on a bounded sample of labelled rows.

Since mean and layer are linear, a bucket's vector enters a score through
its products with the layer alone: tasks hold these (buckets by classes),
and the sums over each different word's own features are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Buckets (a power of two), length of the vectors, lengths of character n-grams.
BUCKETS, DIM, GRAMS = 1 << 17, 8, (3, 4, 5)
#: Fitting takes at most FIT_ROWS labelled rows of each class (smallest hashes of their ids), and in that order rows with
#: FIT_FEATURES different features together at most.
FIT_ROWS, FIT_FEATURES = 2_000, 8_000_000
EPOCHS, RATE, SEED = 4, 4.0, 5
#: Different words a worker keeps.
MAX_WORDS = 400_000
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)   # odd multipliers of the hashes
REPEATED = 0   # the bucket of a word that repeats the one before it


def word_features(words: list[bytes], buckets: int = BUCKETS) -> tuple:
    """(buckets, word) of all features of different words: each word itself and the character n-grams of the word in angle
    brackets, with the place of the word they belong to."""
    import numpy as np
    text = b"<" + b"><".join(words) + b">"
    points = np.frombuffer(text.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    opened = np.zeros(len(points), np.int64)
    sizes = np.array([len(w.decode()) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    opened[starts] = 1
    of, left = np.cumsum(opened) - 1, np.repeat(starts + sizes, sizes) - np.arange(len(points))   # the point's word, points to its end
    found, at = [_bucket(np.array([zlib.crc32(w) for w in words], np.uint64), 1, buckets)], [np.arange(len(words))]
    gram = np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        gram = gram[:len(points) - n + 1] * np.uint64(MIX[0]) + points[n - 1:]
        if n in GRAMS:
            inside = left[:len(gram)] >= n
            found.append(_bucket(gram[inside], n, buckets))
            at.append(of[:len(gram)][inside])
    return np.concatenate(found), np.concatenate(at)


def _bucket(hashes, kind: int, buckets: int):
    import numpy as np
    mixed = (hashes + np.uint64(kind)) * np.uint64(MIX[1])
    return ((mixed ^ mixed >> np.uint64(29)) * np.uint64(MIX[0]) >> np.uint64(40)).astype(np.int64) % buckets


def pair_features(hashes, buckets: int = BUCKETS):
    """Buckets of the pairs of neighbouring words, from the words' 32-bit hashes (as 64-bit integers). A word that repeats the
    one before it is written as a repetition, whatever the word."""
    import numpy as np
    pairs = _bucket(hashes[:-1] * np.uint64(MIX[0]) ^ hashes[1:], 2, buckets)
    return np.where(hashes[:-1] == hashes[1:], REPEATED, pairs)


def document_features(text: str | None, buckets: int = BUCKETS):
    """(buckets, counts) of a whole text; null and wordless texts have none."""
    import numpy as np
    words = text.encode().split() if text else []   # bytes split at ASCII white space only
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kinds: dict[bytes, int] = {}
    ids = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    own, at = word_features(list(kinds), buckets)
    pairs = pair_features(np.array([zlib.crc32(w) for w in kinds], np.uint64)[ids], buckets)
    found, place = np.unique(np.concatenate([own, pairs]), return_inverse=True)
    return found, np.bincount(place, np.append(np.bincount(ids)[at], np.ones(len(pairs)))).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Vectors (bucket, dimension), the layer (dimension, class) and its bias. ``products`` are the vectors' by the layer."""

    vectors: object
    layer: object
    bias: object

    @property
    def products(self):
        return self.vectors @ self.layer

    def probabilities(self, found, counts):
        """Class probabilities of one document's features."""
        import numpy as np
        mean = counts @ self.vectors[found] / max(1, counts.sum())
        return softmax(mean @ self.layer + self.bias)


def softmax(x):
    import numpy as np
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple], classes: int = 2, *, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Model:
    """Stochastic gradient descent on the cross entropy of rows (buckets, counts, class), a row a step, in an order drawn
    anew each epoch; the step length falls linearly to zero."""
    import numpy as np
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
    layer, bias = np.zeros((dim, classes)), np.zeros(classes)
    total, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            found, counts, label = rows[k]
            now = rate * (1 - step / total)
            step += 1
            share = counts / max(1, counts.sum())
            own = vectors[found]
            mean = share @ own
            error = softmax(mean @ layer + bias)
            error[label] -= 1
            back = layer @ error
            layer -= now * np.outer(mean, error)
            bias -= now * 0.1 * error
            vectors[found] = own - now * np.outer(share, back)   # a row's buckets are different
    return Model(vectors, layer, bias)


# --- fitting -----------------------------------------------------------------------------------------------------

def features(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, label, buckets, counts) per row."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"), F.col(text_col).alias("_t"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            for k in range(b.num_rows):
                found, counts = document_features(b.column("_t")[k].as_py())
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(k, 1), b.column("_label").slice(k, 1),
                                                  pa.array([found.tolist()], pa.list_(pa.int32())),
                                                  pa.array([counts.tolist()], pa.list_(pa.int32()))],
                                                 names=["_id", "_label", "found", "counts"])

    return source.mapInArrow(run, f"_id {source.schema['_id'].dataType.simpleString()}, _label int, found array<int>, counts array<int>")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        rows_per_class: int = FIT_ROWS, max_features: int = FIT_FEATURES) -> Model | float:
    """Train on a bounded sample of the labelled documents, as many of label 0 as of label 1 or more where there are so many.

    Null labels and labels of null or absent ids do not count; an id labelled
    twice, or standing in two documents, counts twice. Where one of the two
    labels has no row there is nothing to learn: the result is the smoothed
    share of label 1 among the rows.
    """
    import numpy as np
    marks = labels.select(F.col(id_col).alias("_lid"), (F.col(label_col) > 0).cast("int").alias("_label")) \
        .filter("_lid is not null and _label is not null")
    known = table(marks.join(docs.select(F.col(id_col).alias("_lid")), "_lid", "left_semi"), "subword-labels")
    order = [F.xxhash64("_lid"), "_lid", "_label"]
    picked = [known.filter(F.col("_label") == c).orderBy(*order).limit(rows_per_class) for c in (0, 1)]
    drawn = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")) \
        .join(F.broadcast(picked[0].unionByName(picked[1])), F.col("_id") == F.col("_lid"))   # 2 * rows_per_class ids at most
    sample = table(features(drawn, "_id", "_t", "_label"), "subword-sample")
    held, size = [], 0
    # Repeated ids may give more rows than were drawn: the limit holds for rows as well.
    for r in sample.orderBy(F.xxhash64("_id"), "_id", "_label", "found", "counts").limit(2 * rows_per_class).toLocalIterator():
        size += len(r["found"])
        if size > max_features and held:
            break
        held.append((np.array(r["found"], np.int64), np.array(r["counts"], np.int64), r["_label"]))
    good = sum(label for _, _, label in held)
    if good in (0, len(held)):
        return (good + 1) / (len(held) + 2)
    return train(held)


# --- scoring -----------------------------------------------------------------------------------------------------

class Scorer:
    """A worker's scorer. Sums over the features of each different word are kept, a bounded number of them."""

    def __init__(self, products, bias):
        import numpy as np
        self.products, self.bias, self.buckets = np.ascontiguousarray(products.T), bias, len(products)
        self._reset()

    def _reset(self):
        import numpy as np
        self.number: dict[bytes, int] = {}
        self.sums, self.sizes = np.empty((len(self.bias), 0)), np.empty(0, np.int64)
        self.hashes = np.empty(0, np.uint64)

    def _learn(self, new: list[bytes]) -> None:
        import numpy as np
        found, at = word_features(new, self.buckets)
        self.sums = np.concatenate([self.sums, [np.bincount(at, p[found], len(new)) for p in self.products]], axis=1)
        self.sizes = np.concatenate([self.sizes, np.bincount(at, minlength=len(new))])
        self.hashes = np.concatenate([self.hashes, np.array([zlib.crc32(w) for w in new], np.uint64)])

    def probabilities(self, texts: list[str | None]):
        """Class probabilities per text."""
        import numpy as np
        if len(self.number) > MAX_WORDS:
            self._reset()
        words = [t.encode().split() if t else [] for t in texts]
        number, before = self.number, len(self.number)
        everything = [w for ws in words for w in ws]
        ids = np.fromiter((number.setdefault(w, len(number)) for w in everything), np.int64, len(everything))
        if len(number) > before:
            self._learn(list(number)[before:])
        of = np.repeat(np.arange(len(texts)), [len(ws) for ws in words])
        pairs = pair_features(self.hashes[ids], self.buckets) if len(ids) else np.empty(0, np.int64)
        inside = of[1:] == of[:-1]
        pairs, of_pair = pairs[inside], of[1:][inside]
        size = np.bincount(of, self.sizes[ids], len(texts)) + np.bincount(of_pair, minlength=len(texts))
        total = [np.bincount(of, s[ids], len(texts)) + np.bincount(of_pair, p[pairs], len(texts))
                 for s, p in zip(self.sums, self.products)]
        return softmax(np.stack(total, axis=1) / np.maximum(1, size)[:, None] + self.bias)


_scorers: dict = {}


def _chunks(texts: list, size: int = 1_000_000) -> Iterator[list]:
    held, n = [], 0
    for t in texts:
        if held and n + len(t or "") > size:
            yield held
            held, n = [], 0
        held.append(t)
        n += len(t or "")
    if held:
        yield held


def score_documents(docs: DataFrame, model: Model | float, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row: the probability of label 1.

    Null and empty texts have no features: their score is that of the bias
    alone. Repeated rows give repeated rows, null ids are kept, an empty table
    gives none, other columns are left out.
    """
    import uuid
    if isinstance(model, float):
        return docs.select(id_col, F.lit(model).alias("score"))
    spark, key = docs.sparkSession, uuid.uuid4().hex
    sent = spark.sparkContext.broadcast((model.products, model.bias))   # buckets by classes, whatever the corpus
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))

    def run(batches):
        import pyarrow as pa
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(*sent.value)
        for b in batches:
            texts = b.column("_t").to_pylist()
            scores = [s for chunk in _chunks(texts) for s in _scorers[key].probabilities(chunk)[:, 1].tolist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(scores, pa.float64())], names=["_id", "score"])

    return source.mapInArrow(run, f"_id {source.schema['_id'].dataType.simpleString()}, score double").withColumnRenamed("_id", id_col)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``folds`` (null: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))
