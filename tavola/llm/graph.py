"""Connected components, and postings cut into bounded cells for searches inside a bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node reachable.

    Alternates the large-star and small-star steps until the edges are stars.
    Every step is a map-side combined minimum and one join, written to the
    shared folder, so no component meets in one task or on the driver.
    """
    stars = table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "components")
    before = None
    while True:
        mark = stars.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if mark == before:
            break
        before = mark
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        stars = table(small.select("e.*").filter("a <> b").distinct(), "components")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def cells(postings: DataFrame, key: str, item: Column, chunk: int) -> DataFrame:
    """Postings with the cell they are searched in: columns ``_a``, ``_b``, ``_s`` added.

    A key with at most ``chunk`` postings is one cell (0, 0). A larger one is
    dealt by the hash of the item into ``_s`` chunks, and a cell holds the pair
    of chunks a < b; each row goes to the _s - 1 cells of its chunk. So every
    pair of postings of a key meets in some cell of bounded size. Pairs inside
    chunk a belong to the cell (a, a + 1), those of the last chunk to its cell
    with the one before. Only keys with two postings or more stay.
    """
    sizes = postings.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1") \
        .select(F.col(key).alias("_key"), F.ceil(F.col("_n") / chunk).cast("int").alias("_s"))
    rows = postings.join(sizes, F.col(key) == F.col("_key")).drop("_key") \
        .withColumn("_c", F.pmod(F.xxhash64(item), F.col("_s")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("_s") - 1), lambda j: j != F.col("_c"))
    pairs = F.when(F.col("_s") == 1, F.array(F.struct(F.lit(0).alias("_a"), F.lit(0).alias("_b")))).otherwise(
        F.transform(others, lambda j: F.struct(F.least(j, F.col("_c")).alias("_a"), F.greatest(j, F.col("_c")).alias("_b"))))
    return rows.withColumn("_cell", F.explode(pairs)).select("*", "_cell.*").drop("_cell")


def sorted_cells(spread: DataFrame, key: str, item: str) -> DataFrame:
    """Cells dealt out whole and lying together in each partition."""
    return spread.repartition(F.col(key), F.col("_a"), F.col("_b")).sortWithinPartitions(key, "_a", "_b", item)


def whole_runs(batches, columns: list[str], names: list[str]):
    """Yield record batches regrouped so that no run of equal ``columns`` is split between two."""
    import numpy as np
    import pyarrow as pa
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch]).select(names)
        if held is not None:
            t = pa.concat_tables([held, t]).combine_chunks()
        last, n = t.num_rows, t.num_rows
        if n:
            same = np.ones(n, bool)
            for c in columns:
                v = t.column(c).to_numpy()
                same &= v == v[-1]
            other = np.flatnonzero(~same)
            last = int(other[-1]) + 1 if len(other) else 0
        if last:
            yield t.slice(0, last)
        held = t.slice(last)
    if held is not None and held.num_rows:
        yield held


def run_bounds(table_, columns: list[str]):
    """Start offsets of the runs of equal ``columns`` and the end, as one array."""
    import numpy as np
    n = table_.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        v = table_.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), n)
