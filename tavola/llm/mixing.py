"""Mix sources to target weights with nested hash thresholds, in DataFrame operations only.

Every document has a 60-bit hash. A source's budget is met by whole copies of
the source plus the documents whose hash lies under a threshold. The threshold
is found from histograms of tokens by (source, hash bucket): the first level
has 2^15 buckets per source, and each next level refines only the bucket in
which the budget is crossed. Nothing is sorted by document; the final filter is
a comparison with the threshold. The copies are nested: a larger budget keeps
every document of a smaller one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, present_key, table

LEVEL_BITS, LEVELS = 15, 4
HASH_BITS = LEVEL_BITS * LEVELS
SALTS = 16


def word_count(text):
    """Number of words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_hash(doc_id):
    """60 uniform bits from the id; null ids share the hash of the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(per_source: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """Add ``target`` to (key, source_size): weights by key order, repeating; capped at ``cap`` times the size.

    Capping and resharing the excess until no target is above its cap ends at
    ``min(cap, weight * level)`` with one common level. Sorted by cap / weight,
    the level is the first one that leaves the next source uncapped. The
    windows run over one row per source.
    """
    last = F.col("_key") == "0"   # the null source
    ranked = per_source.withColumn("_rank", F.row_number().over(Window.orderBy(last, "_key"))) \
        .withColumn("_w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                       ((F.col("_rank") - 1) % len(weights) + 1).cast("int")).cast("long")) \
        .withColumn("_cap", F.col("source_size") * F.lit(cap)) \
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_w").cast("double"))
    w = Window.orderBy("_ratio", "_rank")
    everything = Window.partitionBy(F.lit(0))
    stepped = ranked \
        .withColumn("_level", (F.lit(float(share)) * F.sum("source_size").over(everything).cast("double")
                               - F.coalesce(F.sum("_cap").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)).cast("double"))
                    / F.sum("_w").over(w.rowsBetween(0, Window.unboundedFollowing)).cast("double"))
    first = F.min_by(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level")),
                     F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_rank"))).over(everything)
    level = F.coalesce(first, F.lit(float("inf")))
    return stepped.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_w").cast("double") * level)) \
        .select("_key", "source_size", "target")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """One row per document with ``size``, ``source_size``, ``target`` and ``taken`` (words taken, repeats counted).

    Null text has size 0. The null source is a source of its own, ordered last.
    Repeated rows and ids that hash alike are taken or left together. The
    boundary document is taken when that brings the source nearer its target.
    An empty table gives no rows. The result has only the id, the source and
    the columns named here, whatever else the input has.
    """
    sized, plan = mix_plan(docs, id_col, source_col, text_col, weights, share, cap)
    copies = _copies(F.col("_h"))
    return sized.join(_salted(plan), ["_key", "_salt"]) \
        .select(F.col("_id").alias(id_col), F.col("_source").alias(source_col), "size", "source_size", "target",
                (F.col("size") * copies).alias("taken"), copies.cast("int").alias("copies"))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: int = 2) -> DataFrame:
    """The documents themselves, each as often as the mix takes it and at most ``cap`` times, with the input's columns.

    Null and empty texts go with the documents that hash like them. Null ids
    and sources, repeated rows and ties as in ``mix``; columns named like the
    ones made here pass through; an empty table gives no rows.
    """
    _, plan = mix_plan(docs, id_col, source_col, text_col, weights, share, cap)
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
                        present_key(docs[source_col]).alias("_key"), doc_hash(docs[id_col]).alias("_h")) \
        .withColumn("_salt", F.pmod(F.col("_h"), F.lit(SALTS)).cast("int"))
    taken = keyed.join(_salted(plan), ["_key", "_salt"]).withColumn("_n", _copies(F.col("_h"))).filter(F.col("_n") > 0)
    return taken.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_doc.*")


def _copies(h):
    return F.col("_full") + F.when(h < F.col("_cut"), 1).otherwise(0)


def mix_plan(docs: DataFrame, id_col: str, source_col: str, text_col: str, weights: Sequence[int], share: float,
             cap: int) -> tuple[DataFrame, DataFrame]:
    """Sizes and hashes per document, and per source its target, whole copies and hash threshold (both written)."""
    sized = table(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), present_key(F.col(source_col)).alias("_key"),
        word_count(F.col(text_col)).alias("size"), doc_hash(F.col(id_col)).alias("_h")), "mix-sizes") \
        .withColumn("_salt", F.pmod(F.col("_h"), F.lit(SALTS)).cast("int"))

    plan = targets(sized.groupBy("_key").agg(F.sum("size").alias("source_size")), weights, share, cap)
    size = F.col("source_size")
    plan = plan.withColumn("_full", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("long")) \
        .withColumn("_rest", F.col("target") - F.col("_full") * size)

    # Each level adds up only the bucket chosen by the level above. One row per source (times the salts) is joined,
    # so a source with a third of all documents is spread over the salts.
    state = plan.withColumn("_prefix", F.lit(0).cast("long")).withColumn("_base", F.lit(0).cast("long"))
    carried = ["source_size", "target", "_full", "_rest"]
    for level in range(1, LEVELS + 1):
        above, here = HASH_BITS - LEVEL_BITS * (level - 1), HASH_BITS - LEVEL_BITS * level
        hist = sized.join(_salted(state), ["_key", "_salt"]) \
            .filter(F.shiftright("_h", above) == F.col("_prefix")) \
            .groupBy("_key", F.shiftright("_h", here).alias("_b")) \
            .agg(F.sum("size").alias("_sum"), *[F.first(c).alias(c) for c in [*carried, "_base"]])
        w = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        crossed = hist.withColumn("_cum", F.col("_base") + F.sum("_sum").over(w)) \
            .filter(F.col("_cum") > F.col("_rest"))
        state = crossed.groupBy("_key").agg(
            *[F.first(c).alias(c) for c in carried], F.min("_b").alias("_prefix"),
            F.min_by(F.col("_cum") - F.col("_sum"), "_b").alias("_base"), F.min_by("_cum", "_b").alias("_end"))
    take_last = (F.col("_end") - F.col("_rest")) < (F.col("_rest") - F.col("_base"))
    cuts = state.select("_key", (F.col("_prefix") + F.when(take_last, 1).otherwise(0)).alias("_cut"))
    # No threshold without a boundary: sources without a single word, and those whose whole copies meet the target.
    decided = plan.join(cuts, "_key", "left").withColumn(
        "_cut", F.when(F.col("_rest") > 0, F.coalesce("_cut", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")))
    return sized, table(decided, "mix-plan")


def _salted(per_source: DataFrame) -> DataFrame:
    return per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

