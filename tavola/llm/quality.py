"""Quality rules judged by an isolation forest on their statistics.

Every text is reduced to rule statistics. Trees split a bounded sample of
labelled good documents at random; documents that a few such splits set apart
have short paths and are anomalous. The limit on the anomaly score is
calibrated on all labelled rows. Two base rules reject on their own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = re.compile(r"[#*$%&|<>]")
MARKS = re.compile(r"[^\w\s]+")
SPACES = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_lines")
#: The forest is fitted on at most FIT_ROWS labelled rows (smallest hashes of their ids), each tree on TREE_ROWS of them.
FIT_ROWS, TREES, TREE_ROWS, DEPTH, SEED = 20_000, 150, 256, 12, 11
#: Splits are drawn from a node's range widened by this share on either side: values beyond it are set apart at once.
MARGIN = 1.0
#: The calibrated limit rejects at most this share of the good labelled rows; scores are counted in so many bins.
MAX_GOOD_LOST, BINS = 0.002, 2000


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text (null: none): words, code points in words, symbols, lines with a word that repeat an
    earlier line, words in 3-word windows found twice or more, marks (no letter, digit, underscore or space), lines
    with a word."""
    import numpy as np
    words = text.encode().split() if text else []   # bytes split at ASCII white space only
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeated = 0
    if n > 3:
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, window, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        again, mark = times[window] > 1, np.zeros(n, bool)
        for k in range(3):
            mark[k:k + n - 2] |= again
        repeated = int(mark.sum())
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (n, len(text) - sum(map(text.count, SPACES)), len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated,
            sum(map(len, MARKS.findall(text))), len(lines))


def base_failed(counts):
    """Base rules on rows of COUNTS."""
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def features(counts):
    """Rule statistics that do not grow with the length of a text."""
    import numpy as np
    c = counts.astype(float).T
    words, chars, lines = (np.maximum(c[i], 1) for i in (0, 1, 6))
    return np.stack([c[1] / words, np.log1p(100 * c[2] / chars), np.log1p(100 * c[5] / chars), c[3] / lines, c[4] / words], axis=1)


@dataclass(frozen=True)
class Forest:
    """Trees as arrays (tree, node): feature, split, children; leaves lead to themselves and hold their path length."""

    feature: object
    split: object
    left: object
    right: object
    length: object
    usual: float

    def score(self, x):
        """Anomaly from 0 to 1: 2 ** -(mean path length / the usual one)."""
        import numpy as np
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for f, s, a, b, h in zip(self.feature, self.split, self.left, self.right, self.length):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(x[rows, f[at]] < s[at], a[at], b[at])
            total += h[at]
        return 2.0 ** (-total / (len(self.feature) * self.usual))


def unsuccessful(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    import math
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_forest(x, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    import numpy as np
    rng = np.random.default_rng(seed)
    made = []
    for _ in range(trees):
        nodes: list[list] = []

        def grow(part, depth):
            me = len(nodes)
            nodes.append([0, 0.0, me, me, depth + unsuccessful(len(part))])
            if depth < DEPTH and len(part) > 1:
                f = int(rng.integers(x.shape[1]))
                lo, hi = part[:, f].min(), part[:, f].max()
                wide = MARGIN * (hi - lo) or 1e-3
                cut = float(rng.uniform(lo - wide, hi + wide))
                under = part[:, f] < cut
                nodes[me][:2] = f, cut
                nodes[me][2] = grow(part[under], depth + 1)
                nodes[me][3] = grow(part[~under], depth + 1)
            return me

        grow(x[rng.choice(len(x), min(rows, len(x)), replace=False)], 0)
        made.append(nodes)
    size = max(map(len, made))
    columns = [np.array([[n[k] for n in t] + [0] * (size - len(t)) for t in made]) for k in range(5)]
    return Forest(columns[0], columns[1].astype(float), columns[2], columns[3], columns[4].astype(float),
                  unsuccessful(min(rows, len(x))) or 1.0)


@dataclass(frozen=True)
class Judge:
    """A forest and the score above which a text is rejected. Without good labelled rows there is no forest: only the
    base rules reject."""

    forest: Forest | None
    limit: float

    def scores(self, counts):
        import numpy as np
        return np.zeros(len(counts)) if self.forest is None else self.forest.score(features(counts))

    def kept(self, counts):
        return ~base_failed(counts) & (self.scores(counts) <= self.limit)


def pick_limit(good: dict[int, int], bad: dict[int, int], max_lost: float = MAX_GOOD_LOST, bins: int = BINS) -> float:
    """The score limit from counts of labelled rows by bin of score.

    Of the limits that lose at most ``max_lost`` of the good rows, those that
    reject most bad rows less good ones (by share); the middle of their range.
    """
    n_good, n_bad = max(1, sum(good.values())), max(1, sum(bad.values()))
    lost, caught = n_good * (sum(good.values()) > 0), n_bad * (sum(bad.values()) > 0)
    options = []
    for k in range(bins + 1):   # limit k rejects the bins from k on
        if k:
            lost -= good.get(k - 1, 0)
            caught -= bad.get(k - 1, 0)
        if lost <= max_lost * n_good:
            options.append((caught / n_bad - lost / n_good, k))
    best = max(v for v, _ in options)
    ks = [k for v, k in options if v >= best - 1e-12]
    end = next((i for i, (a, b) in enumerate(zip(ks, ks[1:])) if b != a + 1), len(ks) - 1)
    return (ks[0] + ks[end]) / 2 / bins


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, *COUNTS) per document."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            rows = [text_counts(t) for t in b.column("_t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_id"), *(pa.array(c, pa.int64()) for c in zip(*rows))] if rows else
                                             [b.column("_id"), *(pa.array([], pa.int64()) for _ in COUNTS)], names=["_id", *COUNTS])

    schema = f"_id {source.schema['_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return source.mapInArrow(run, schema)


def _matrix(batch):
    import numpy as np
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1).astype(np.int64)


def judged(stats: DataFrame, judge: Judge) -> DataFrame:
    """Statistics plus ``base_failed``, ``score`` and ``kept``."""
    names = stats.columns

    def run(batches):
        import pyarrow as pa
        for b in batches:
            m = _matrix(b)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(base_failed(m)), pa.array(judge.scores(m)),
                                              pa.array(judge.kept(m))], names=[*names, "base_failed", "score", "kept"])

    schema = T.StructType([*stats.schema.fields, T.StructField("base_failed", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    return stats.mapInArrow(run, schema)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> Judge:
    """Fit the forest on a bounded sample of good labelled rows and the limit on all labelled rows.

    ``stats`` should be written already. Labels that are null, or of ids that
    are null or absent, do not count; an id labelled twice counts twice.
    """
    import numpy as np
    marks = labels.select(F.col(id_col).alias("_lid"), F.col(quality_col).alias("_q")).filter("_lid is not null and _q is not null")
    labelled = stats.join(marks, F.col("_id") == F.col("_lid")).select("_id", *COUNTS, (F.col("_q") > 0).alias("_good"))
    fair = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    labelled = table(labelled.filter(fair), "quality-labelled")
    sample = labelled.filter("_good").orderBy(F.xxhash64("_id"), "_id", *COUNTS).limit(FIT_ROWS).select(*COUNTS).collect()
    if not sample:
        return Judge(None, 1.0)
    judge = Judge(grow_forest(features(np.array([tuple(r) for r in sample], np.int64))), 1.0)
    bins = judged(labelled, judge).groupBy("_good", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin")) \
        .count().collect()
    good, bad = ({r["bin"]: r["count"] for r in bins if r["_good"] == g} for g in (True, False))
    return Judge(judge.forest, pick_limit(good, bad))


def judge_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, COUNTS, ``base_failed``, ``score``, ``kept``.

    Null and wordless texts have counts of 0 and fail. Repeated rows give
    repeated result rows; an empty table gives none. Extra columns are left out.
    """
    stats = table(statistics(docs, id_col, text_col), "quality-stats")
    return judged(stats, fit(stats, labels, id_col)).withColumnRenamed("_id", id_col)


def kept_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their columns, whatever their names.

    Null and wordless texts fail. Repeated rows pass or fail together, null ids
    like any other; labels that are null, or of null or absent ids, do not
    count; an empty table gives none.
    """
    judge = fit(table(statistics(docs, id_col, text_col), "quality-stats"), labels, id_col)
    return docs.filter(passes(judge, F.col(text_col)))


def passes(judge: Judge, text: Column) -> Column:
    """Whether a text passes the judge."""
    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        import numpy as np
        return pd.Series(judge.kept(np.array([text_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))))

    return run(text)
