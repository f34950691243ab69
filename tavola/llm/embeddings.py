"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations, with multiprobe and exact checks.

A rotation is three rounds of random signs and a Walsh-Hadamard transform. The
hash of a rotated vector is its largest coordinate and that coordinate's sign.
A table joins two such hashes, and every vector is put into the buckets of its
two best choices in each (four per table), so that a pair meets if any choice
agrees. Pairs that meet are compared by cosine in double precision. Equal
vectors are one class from the start. A bucket of any size is cut into cells of
bounded size; what leaves a cell are link counts per class and a spanning
forest, never the pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .graph import cells, connected_components, run_bounds, sorted_cells, whole_runs

TABLES, HASHES, ROUNDS, CHUNK, SEED = 4, 2, 3, 1024, 20240501


def hadamard(x):
    """Walsh-Hadamard transform of every row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        a, b = y[:, :, 0, :] + y[:, :, 1, :], y[:, :, 0, :] - y[:, :, 1, :]
        y[:, :, 0, :], y[:, :, 1, :] = a, b
        h *= 2
    return x


def bucket_codes(vectors, tables: int = TABLES, seed: int = SEED):
    """(n, tables, 4) bucket numbers: the two best cross-polytope corners of each of two rotations, combined."""
    import numpy as np
    n, d = vectors.shape
    width = max(2, 1 << (d - 1).bit_length())
    signs = np.random.default_rng(seed).integers(0, 2, (tables, HASHES, ROUNDS, width)) * 2.0 - 1
    codes = np.empty((n, tables, 4), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best = []
        for k in range(HASHES):
            x = np.zeros((n, width))
            x[:, :d] = vectors
            for r in range(ROUNDS):
                x = hadamard(x * signs[t, k, r])
            size = np.abs(x)
            first = size.argmax(axis=1)
            one = first * 2 + (x[rows, first] < 0)
            size[rows, first] = -1
            second = size.argmax(axis=1)
            best.append((one, second * 2 + (x[rows, second] < 0)))
        for j, (p, q) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
            codes[:, t, j] = (best[0][p] * (2 * width) + best[1][q]) * tables + t
    return codes


def _matrix(column):
    import numpy as np
    return np.frombuffer(b"".join(column.to_pylist()), "<f4").reshape(len(column), -1).astype(np.float64)


def classes(vectors: DataFrame) -> DataFrame:
    """Rows (id, label, embedding) with ``cls``: the hash of label and vector, or null for vectors that link with nothing.

    Those are null, empty or all zero ones, ones with null or non-finite
    components, and ones without a label.
    """
    v = F.col("embedding")
    fine = F.col("label").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                                                  & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.withColumn("cls", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "embedding", F.size(v))))


def search(distinct: DataFrame, min_cosine: float, tables: int = TABLES) -> DataFrame:
    """(a, b, links) from classes (cls, label, embedding, copies): links of a (b = a), and edges that span them (links 0)."""
    numbered = distinct.select("cls", "label", "embedding", "copies")

    def hashed(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            lists = b.column("embedding").to_pylist()
            dims = np.array([len(x) for x in lists])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                m = np.array([lists[i] for i in at], np.float32)
                codes = bucket_codes(m.astype(np.float64), tables)
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [b.column("cls").take(rows), b.column("label").take(rows), b.column("copies").take(rows),
                     pa.array([x.tobytes() for x in m], pa.binary()),
                     pa.array(list(codes.reshape(len(at), -1)), pa.list_(pa.int64()))],
                    names=["cls", "label", "copies", "vec", "codes"])

    label = distinct.schema["label"].dataType.simpleString()
    coded = table(numbered.mapInArrow(hashed, f"cls long, label {label}, copies long, vec binary, codes array<bigint>"),
                  "embedding-codes")
    postings = coded.select("cls", "copies", "vec", F.col("label").alias("_l"), F.explode("codes").alias("code")) \
        .withColumn("key", F.xxhash64("_l", F.length("vec"), "code")).drop("_l")
    spread = sorted_cells(cells(postings, "key", F.col("cls"), CHUNK), "key", "cls")
    columns = ["key", "_a", "_b"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        none = np.empty(0, np.int64)
        for t in whole_runs(batches, columns, [*columns, "_c", "_s", "cls", "copies", "code", "vec"]):
            bounds = run_bounds(t, columns)
            out = [(none, none, none)]
            for lo, hi in zip(bounds, bounds[1:]):
                if hi - lo > 1:
                    out.append(cell_links(t.slice(lo, hi - lo), min_cosine, tables))
            a, b, n = (np.concatenate(x) for x in zip(*out))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "links"])

    return spread.mapInArrow(run, "a long, b long, links long")


def cell_links(t, min_cosine: float, tables: int):
    """Links inside one cell. A pair that meets in several buckets counts in the first table and bucket it shares."""
    import numpy as np
    cls, copies, code = t.column("cls").to_numpy(), t.column("copies").to_numpy(), t.column("code").to_numpy()
    m = _matrix(t.column("vec"))
    chunk, s = t.column("_c").to_numpy(), int(t.column("_s")[0].as_py())
    x, y = int(t.column("_a")[0].as_py()), int(t.column("_b")[0].as_py())
    norm = np.sqrt((m * m).sum(axis=1))
    codes = None
    n = len(cls)
    links = np.zeros(n, np.int64)
    left, right = [], []
    group = np.arange(n)
    for i in range(0, n, 512):
        rows = slice(i, min(n, i + 512))
        cosine = (m[rows] @ m.T) / (norm[rows, None] * norm[None, :])
        p, q = np.nonzero(cosine >= min_cosine)
        p += i
        ok = p < q
        if s > 1:   # pairs inside a chunk belong to one of the chunk's cells only
            ok &= (chunk[p] != chunk[q]) | ((chunk[p] == x) & (y == x + 1)) | ((chunk[p] == y) & (y == s - 1) & (x == y - 1))
        p, q = p[ok], q[ok]
        if not len(p):
            continue
        if codes is None:
            codes = bucket_codes(m, tables)
        for j in range(0, len(p), 1 << 16):
            a, b = p[j:j + (1 << 16)], q[j:j + (1 << 16)]
            same = codes[a][:, :, :, None] == codes[b][:, :, None, :]
            shared = np.where(same.any(axis=3), codes[a], np.iinfo(np.int64).max).min(axis=2)   # per table
            first = shared[np.arange(len(a)), (shared < np.iinfo(np.int64).max).argmax(axis=1)]
            mine = first == code[a]
            a, b = a[mine], b[mine]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            # Edges by hooking: keep those that join two groups, until all linked members share one.
            while len(a):
                ga, gb = group[a], group[b]
                apart = ga != gb
                a, b, ga, gb = a[apart], b[apart], ga[apart], gb[apart]
                if not len(a):
                    break
                hi, lo = np.maximum(ga, gb), np.minimum(ga, gb)
                top, at = np.unique(hi, return_index=True)
                left.append(cls[a[at]])
                right.append(cls[b[at]])
                group[top] = lo[at]
                while (group != group[group]).any():
                    group = group[group]
    has = np.flatnonzero(links)
    a = np.concatenate([cls[has], *left])
    b = np.concatenate([cls[has], *right])
    return a, b, np.concatenate([links[has], np.zeros(len(a) - len(has), np.int64)])


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = 0.98, tables: int = TABLES) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id reachable, itself included) and ``kept``.

    Vectors link when their labels are equal and their cosine is at least
    ``min_cosine``. Repeated rows link like any other equal vectors. Null ids
    count as members, but a component takes its id from the others; a row whose
    component has no id at all is kept. An empty table gives no rows, and extra
    columns are left out.
    """
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<float>").alias("embedding"))
    marked = classes(rows)
    members = table(marked.select("_id", "cls"), "embedding-members")
    distinct = marked.filter("cls is not null").groupBy("cls").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"))
    found = table(search(distinct, min_cosine, tables).groupBy("a", "b").agg(F.sum("links").alias("links")),
                  "embedding-links")
    links = found.filter("a = b").select(F.col("a").alias("_lc"), "links")
    label = connected_components(found.filter("a <> b").select("a", "b"))
    size = members.filter("cls is not null").groupBy("cls").agg(F.count(F.lit(1)).alias("_copies"), F.min("_id").alias("_first"))
    info = size.join(links, F.col("cls") == F.col("_lc"), "left").join(label, F.col("cls") == F.col("node"), "left") \
        .select("cls", (F.col("_copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "_first",
                F.coalesce("component", "cls").alias("_label"))
    least = info.groupBy("_label").agg(F.min("_first").alias("_least")).withColumnRenamed("_label", "_of")
    info = table(info.join(least, F.col("_label") == F.col("_of")).select("cls", "n_links", "_least"), "embedding-info")
    out = members.filter("cls is not null").join(info, "cls").select("_id", "n_links", "_least") \
        .unionByName(members.filter("cls is null").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("_least")))
    return out.select(F.col("_id").alias(id_col), "n_links", F.col("_least").alias("component_id"),
                      F.col("_id").eqNullSafe(F.col("_least")).alias("kept"))
