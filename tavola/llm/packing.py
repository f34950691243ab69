"""Best-fit packing planned on the histogram of lengths.

Only counts of pieces per length reach the planner: at most ``max_len`` of
them, whatever the size of the corpus. Best-fit decreasing places whole counts
at a time, so a plan is a list of sequence kinds, each made some number of
times. Pieces then take their places by joining on their rank within their
length, so no piece is sorted against pieces of other lengths and no list of
documents leaves the executors.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

ROWS_PER_SALT = 1_000_000   # pieces of one length ranked in one task


def tokenized_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                     max_len: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and its end id, cut if longer than ``max_len``.

    The first piece holds what is left over, the others exactly ``max_len``.
    Null text is a document of its end id alone.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    id_type = source.schema["_id"].dataType.simpleString()
    extra = ", ids array<int>" if with_ids else ""

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        from .tokens import encoder
        enc = encoder(tokenizer)
        for b in batches:
            ids, at = enc.encode(b.column("_t").to_pylist())
            rows: list[tuple[int, int, int, int, int]] = []
            pieces = []
            for k in range(b.num_rows):
                mine = np.append(ids[at[k]:at[k + 1]], np.uint32(end_id)).astype("<u4")
                first = len(mine) % max_len or max_len
                cuts = [0, *range(first, len(mine) + 1, max_len)]
                for n, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((k, n, x, y - x, zlib.crc32(mine[x:y].tobytes())))
                    if with_ids:
                        pieces.append(mine[x:y].astype(np.int32))
            if not rows:
                continue
            of, piece, start, length, crc = (np.array(c, np.int64) for c in zip(*rows))
            cols = [b.column("_id").take(pa.array(of)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(pieces, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return source.mapInArrow(run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long{extra}")


def best_fit(counts: dict[int, int], max_len: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Sequence kinds (how many, ((length, times), ...)) from best-fit decreasing over counts of lengths.

    Lengths are taken from the longest down. Pieces of one length go first to
    the open kind with the least room that still holds one; of a kind that is
    not used up, part stays as it was. What finds no room opens new sequences.
    """
    kinds: dict[int, list[list]] = {}   # room left -> [[how many, contents], ...]
    rooms: list[int] = []               # sorted keys of kinds
    full: list[tuple[int, tuple]] = []

    def put(room: int, many: int, contents: tuple) -> None:
        if not many:
            return
        if room == 0:
            full.append((many, contents))
            return
        if room not in kinds:
            kinds[room] = []
            insort(rooms, room)
        kinds[room].append([many, contents])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = max_len // length
                whole, rest = divmod(left, each)
                put(max_len - each * length, whole, ((length, each),))
                put(max_len - rest * length, 1 if rest else 0, ((length, rest),))
                break
            room = rooms[i]
            many, contents = kinds[room].pop()
            if not kinds[room]:
                del kinds[room]
                rooms.pop(i)
            each = room // length
            whole = min(many, left // each)
            put(room - each * length, whole, (*contents, (length, each)))
            left -= whole * each
            if whole < many:
                rest = min(left, each) if left < each else 0
                if rest:
                    put(room - rest * length, 1, (*contents, (length, rest)))
                    left -= rest
                put(room, many - whole - (1 if rest else 0), contents)
    return full + [(many, contents) for group in kinds.values() for many, contents in group]


def slot_runs(plan: list[tuple[int, tuple[tuple[int, int], ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """The plan by length: (length, first rank, end rank, first sequence, times in it, offset of the first of them)."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for many, contents in plan:
        offset = 0
        for length, times in contents:
            rank = used.get(length, 0)
            runs.append((length, rank, rank + many * times, sequence, times, offset))
            used[length] = rank + many * times
            offset += length * times
        sequence += many
    return runs


def pack(pieces: DataFrame, max_len: int = 2048) -> DataFrame:
    """``pieces`` (columns of ``tokenized_pieces``, lengths from 1 to ``max_len``) plus ``sequence_id`` and ``offset``.

    The table should be written already: it is read for the counts and for the
    ranks. Pieces equal in every column may stand in any order. No rows give no
    rows.
    """
    spark = pieces.sparkSession
    # The rank within a length is taken per salt and moved on by the counts of the salts before, for one length may
    # have a third of all pieces. Lengths are at most max_len rows, lengths by salt that plus one per million pieces.
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    salts = F.broadcast(spark.createDataFrame([(k, -(-n // ROWS_PER_SALT)) for k, n in lengths.items()], "_sl long, _salts long"))
    salted = pieces.join(salts, F.col("length") == F.col("_sl")) \
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_salts")).cast("int")).drop("_sl", "_salts")
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n")).collect()
    totals: dict[int, int] = {}
    before = []
    for r in sorted(counts, key=lambda r: (r["length"], r["_salt"])):
        before.append((r["length"], r["_salt"], totals.get(r["length"], 0)))
        totals[r["length"]] = totals.get(r["length"], 0) + r["n"]
    if any(not 1 <= x <= max_len for x in totals):
        raise ValueError(f"lengths must be from 1 to {max_len}")
    runs = slot_runs(best_fit(totals, max_len))
    # Both small tables are bounded by max_len, not by the data.
    offsets = F.broadcast(spark.createDataFrame(before, "_l long, _s int, _before long"))
    places = F.broadcast(spark.createDataFrame(runs, "_len long, _lo long, _hi long, _seq long, _times long, _off long"))
    w = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("_rn", F.row_number().over(w)) \
        .join(offsets, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s"))) \
        .withColumn("_rank", F.col("_before") + F.col("_rn") - 1)
    placed = ranked.join(places, (F.col("length") == F.col("_len")) & (F.col("_rank") >= F.col("_lo"))
                         & (F.col("_rank") < F.col("_hi")))
    at = F.col("_rank") - F.col("_lo")
    return placed.select(*[F.col(c) for c in pieces.columns],
                         (F.col("_seq") + F.floor(at / F.col("_times"))).cast("long").alias("sequence_id"),
                         (F.col("_off") + (at % F.col("_times")) * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids, from packed pieces that carry ``ids``. A sequence has at most max_len ids."""
    return packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p")) \
        .select("sequence_id", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 0, **columns) -> DataFrame:
    """Tokenize whole documents and pack them; one row per piece. Extra input columns are left out."""
    return pack(table(tokenized_pieces(docs, tokenizer, max_len=max_len, end_id=end_id, **columns), "pack-pieces"), max_len)
