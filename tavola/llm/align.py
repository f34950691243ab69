"""Alignment of two tokenizers' tokens over the bytes of each text.

Tokenizer A is a byte-level vocabulary of the tokenizers library, B a
sentencepiece model that writes a space before the text; A reads the text
with that space, so both sides cover the same bytes. The tokens of a batch
of documents lie behind each other on one byte axis. ``merge_asof``, keyed
by document, gives each token start the other side's covering token; both
directions together are all overlapping pairs. Overlaps that end together
are links, and their ends cut the tokens of a document into groups.

Of two tokens that end together the shorter one is a suffix of the longer.
So there are at most as many different linked id pairs as the entries of
both vocabularies have suffixes (``pair_bound``), whatever the corpus: the
table of pair counts is small enough to send to every worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .tokens import NO_SPACE, Encoder

SPACE_MARK = "▁"
#: Characters of text aligned at once; a longer text is aligned on its own.
CHUNK_CHARS = 400_000
#: Different pieces a worker remembers, with both sides' ids.
MAX_PIECES = 500_000
#: Rows of the link table read at once.
COUNT_ROWS = 400

# Fixed values of byte-level vocabularies: bytes written as themselves; the others are written from code point 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_encoders: dict = {}


def byte_level_entries(tokenizer) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    hidden = [b for b in range(256) if b not in SHOWN]
    byte_of = {chr(b): b for b in SHOWN} | {chr(256 + k): b for k, b in enumerate(hidden)}
    entries = [b""] * tokenizer.get_vocab_size()
    for entry, n in tokenizer.get_vocab().items():
        entries[n] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return entries


def piece_entries(model) -> list[bytes]:
    """Bytes of each id of a sentencepiece model."""
    pieces = ((model.id_to_piece(n), model.is_byte(n)) for n in range(model.get_piece_size()))
    return [bytes([int(p[3:-1], 16)]) if byte else p.replace(SPACE_MARK, " ").encode() for p, byte in pieces]


def pair_bound(entries_a: list[bytes], entries_b: list[bytes]) -> int:
    """Most different id pairs whose tokens can end together: each id of one side with the other side's ids that are a suffix
    of it (a suffix may stand in a vocabulary twice, as a piece and as a byte)."""
    return 2 * sum(map(len, entries_a)) + 2 * sum(map(len, entries_b))


@dataclass(frozen=True)
class Tokens:
    """Ids of a run of documents: document k has ``ids[offsets[k]:offsets[k + 1]]``; ``sizes`` are bytes."""

    ids: object
    offsets: object
    sizes: object

    @property
    def ends(self):
        import numpy as np
        return np.cumsum(self.sizes, dtype=np.int64)

    def documents(self):
        """The document number of each token."""
        import numpy as np
        return np.repeat(np.arange(len(self.offsets) - 1, dtype=np.int32), np.diff(self.offsets))


class PairEncoder(Encoder):
    """Both tokenizers' ids of whole texts. Pieces that neither tokenizer joins to their neighbours are encoded once.

    The cuts of the byte-level vocabulary hold for a sentencepiece model as
    well if no piece of it holds white space after another character, a line
    feed, or a full stop or comma after a letter; otherwise texts are encoded
    whole on both sides.
    """

    def __init__(self, path_a: str, path_b: str):
        import re

        import numpy as np
        import sentencepiece
        super().__init__(path_a, plain_specials=True)
        self.other = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.entries = byte_level_entries(self.tok), piece_entries(self.other)
        self.sizes = tuple(np.array([len(e) for e in entries], np.int32) for entries in self.entries)
        pieces = [self.other.id_to_piece(n) for n in range(self.other.get_piece_size()) if not self.other.is_byte(n)]
        joins = re.compile(rf"[^{SPACE_MARK}]{SPACE_MARK}|\n|[a-zA-Z][.,]")
        self.cuts_hold = not self.words and not any(joins.search(p) for p in pieces)

    def _reset(self):
        import numpy as np
        super()._reset()
        self.start_b, self.flat_b = np.zeros(1, np.int64), np.empty(0, np.uint32)
        self.same = np.empty(0, bool)

    def _other_whole(self, text: str):
        import numpy as np
        return np.array(self.other.encode(text), np.uint32)

    def _learn(self) -> None:
        import numpy as np
        new = list(self.index.new)
        super()._learn()
        # The model writes its space before a text: it stands for the piece's own, or before a line feed that is cut off.
        bare = [p[:1] == NO_SPACE for p in new]
        found = self.other.encode(["\n" + p[1:] if b else p for p, b in zip(new, bare)], num_threads=1)
        found = [ids[2:] if b else ids for ids, b in zip(found, bare)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.start_b = np.concatenate([self.start_b, self.start_b[-1] + np.cumsum(size)])
        self.flat_b = np.concatenate([self.flat_b, np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))])
        entries = self.entries[1]
        same = [b"".join([entries[i] for i in ids]) == (p[1:] if b else " " + p).encode() for ids, p, b in zip(found, new, bare)]
        self.same = np.concatenate([self.same, np.array(same, bool)])

    def _text_pieces(self, text: str) -> list[str]:
        """Pieces of the text with a space before it."""
        pieces = self._pieces(text)
        pieces[0] = pieces[0].removeprefix(NO_SPACE)
        return pieces

    def _gather(self, groups: list[list[str]]):
        """For each list of pieces its ids on both sides; none where a piece does not decode to itself."""
        import numpy as np
        everything = [p for ps in groups for p in ps]
        if len(self.index) > MAX_PIECES:   # the cache is bounded
            self._reset()
        at = np.fromiter(map(self.index.__getitem__, everything), np.int64, len(everything))
        if self.index.new:
            self._learn()
        of = np.append(0, np.cumsum([len(ps) for ps in groups]))
        bad = np.append(0, np.cumsum(~self.same[at]))
        right = bad[of[1:]] == bad[of[:-1]]
        if not right.all():
            at = at[np.repeat(right, np.diff(of))]
            of = np.append(0, np.cumsum(np.where(right, np.diff(of), 0)))
        sides = []
        for start, flat in ((self.start, self.flat), (self.start_b, self.flat_b)):
            size = start[at + 1] - start[at]
            end = np.append(0, np.cumsum(size))
            ids = flat[np.repeat(start[at] - end[:-1], size) + np.arange(end[-1])]
            sides.append((ids, end[of]))
        return sides

    def _odd(self, text: str):
        """Both sides of a text encoded whole; none if its bytes are not those of the text with a space before it."""
        import numpy as np
        a, b, wanted = self._whole(" " + text), self._other_whole(text), (" " + text).encode()
        for ids, entries in zip((a, b), self.entries):
            if b"".join([entries[i] for i in ids.tolist()]) != wanted:
                return np.empty(0, np.uint32), np.empty(0, np.uint32)
        return a, b

    def pair(self, texts: list[str | None]) -> tuple[Tokens, Tokens]:
        """Tokens of both sides. Texts that are null, empty or not given back by both sides have none."""
        import numpy as np
        plain = [bool(t) and self.cuts_hold and self._safe(t) for t in texts]
        groups = [self._text_pieces(t) if p else [] for t, p in zip(texts, plain)]
        (ids_a, off_a), (ids_b, off_b) = self._gather(groups)
        odd = {k: self._odd(t) for k, (t, p) in enumerate(zip(texts, plain)) if t and not p}
        sides = []
        for side, (ids, off) in enumerate(((ids_a, off_a), (ids_b, off_b))):
            if odd:
                parts = [odd[k][side] if k in odd else ids[off[k]:off[k + 1]] for k in range(len(texts))]
                ids, off = np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
            sides.append(Tokens(ids, off, self.sizes[side][ids]))
        return sides[0], sides[1]


def pair_encoder(path_a: str, path_b: str) -> PairEncoder:
    """The worker's encoder for two vocabulary files."""
    if (path_a, path_b) not in _encoders:
        _encoders[path_a, path_b] = PairEncoder(path_a, path_b)
    return _encoders[path_a, path_b]


def overlaps(a: Tokens, b: Tokens) -> tuple:
    """All pairs (i, j) of token positions whose byte ranges overlap, once each.

    Both sides must cover the same bytes of every document. Each start of a
    token lies in one token of the other side; two tokens that overlap hold
    the start of one of them, so the two directions together miss none.
    """
    import numpy as np
    import pandas as pd
    total = int(a.sizes.sum(dtype=np.int64))
    kind = np.int32 if total < 2**31 else np.int64
    frames = []
    for side in (a, b):
        start = (side.ends - side.sizes).astype(kind)
        frames.append(pd.DataFrame({"start": start, "doc": side.documents(), "at": np.arange(len(start), dtype=np.int32)}))
    on_a, on_b = frames
    over_b = pd.merge_asof(on_a[["start", "doc"]], on_b, on="start", by="doc")["at"].to_numpy()
    over_a = pd.merge_asof(on_b[["start", "doc"]], on_a, on="start", by="doc")["at"].to_numpy()
    other = np.flatnonzero(on_a["start"].to_numpy()[over_a] != on_b["start"].to_numpy())   # not found from A's starts already
    return np.concatenate([on_a["at"].to_numpy(), over_a[other]]), np.concatenate([over_b, other])


def ending_together(a: Tokens, b: Tokens, pairs: tuple) -> tuple:
    """The overlapping pairs that end at the same byte, in order: the last tokens of each group."""
    import numpy as np
    i, j = pairs
    together = a.ends[i] == b.ends[j]
    partner = np.full(len(a.ids), -1, np.int64)
    partner[i[together]] = j[together]
    last = np.flatnonzero(partner >= 0)
    return last, partner[last]


class Writer:
    """Writes the groups of documents as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_a: int, n_b: int):
        self.n_a, self.n_b = n_a, n_b
        self.marked = [f"{n}{mark}" for size, marks in ((n_a, ",|"), (n_b, ",;")) for mark in marks for n in range(size)]

    def codes(self, a: Tokens, b: Tokens, last_a, last_b):
        """Tokens of both sides in the order of writing, each with the mark that follows it."""
        import numpy as np
        ends_a, ends_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        out = np.empty(len(a.ids) + len(b.ids), np.int64)
        out[np.arange(len(a.ids)) + np.append(0, last_b + 1)[group_a]] = a.ids + self.n_a * ends_a
        out[np.arange(len(b.ids)) + np.append(last_a + 1, 0)[group_b]] = 2 * self.n_a + b.ids + self.n_b * ends_b
        return out

    def text(self, codes) -> str:
        return "".join(map(self.marked.__getitem__, codes.tolist()))[:-1]


def _chunks(batch, size: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list]]:
    texts = batch.column("_t").to_pylist()
    start, held = 0, 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if held and held + n > size:
            yield start, k, texts[start:k]
            start, held = k, 0
        held += n
    if start < len(texts):
        yield start, len(texts), texts[start:]


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    return source, source.schema["_id"].dataType.simpleString()


def alignments(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``a_ids``, ``b_ids``, ``overlaps`` (positions a, b and whether both end together) and
    ``groups`` (number of A and of B tokens in each).

    Null and empty texts, and texts whose tokens do not give back a space and
    the text, have empty lists. Repeated rows give repeated rows, null ids are
    kept, an empty table gives none, other columns are left out.
    """
    source, id_type = _source(docs, id_col, text_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        encoder = pair_encoder(path_a, path_b)

        def lists(offsets, values):
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

        for batch in batches:
            for start, stop, texts in _chunks(batch):
                a, b = encoder.pair(texts)
                i, j = overlaps(a, b)
                order = np.lexsort((j, i))
                i, j = i[order], j[order]
                last_a, last_b = ending_together(a, b, (i, j))
                of_pair = np.searchsorted(i, a.offsets)
                of_group = np.searchsorted(last_a, a.offsets)
                group_a, group_b = (np.diff(np.append(-1, x)) for x in (last_a, last_b))
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(start, stop - start), lists(a.offsets, pa.array(a.ids.astype(np.int32))),
                    lists(b.offsets, pa.array(b.ids.astype(np.int32))),
                    lists(of_pair, pa.StructArray.from_arrays([
                        pa.array((i - np.repeat(a.offsets[:-1], np.diff(of_pair))).astype(np.int32)),
                        pa.array((j - np.repeat(b.offsets[:-1], np.diff(of_pair))).astype(np.int32)),
                        pa.array(a.ends[i] == b.ends[j])], ["a", "b", "end_together"])),
                    lists(of_group, pa.StructArray.from_arrays([pa.array(group_a.astype(np.int32)), pa.array(group_b.astype(np.int32))],
                                                               ["n_a", "n_b"]))],
                    names=["_id", "a_ids", "b_ids", "overlaps", "groups"])

    return source.mapInArrow(run, f"_id {id_type}, a_ids array<int>, b_ids array<int>, "
                                  "overlaps array<struct<a:int,b:int,end_together:boolean>>, groups array<struct<n_a:int,n_b:int>>") \
        .withColumnRenamed("_id", id_col)


def links(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256`` and ``links``, the id pairs of its
    linked tokens in order: A's and B's id as little-endian integers of 16 bits, or of 32 bits if a vocabulary needs them.

    Cases as in ``alignments``; without tokens the digest and the links are empty.
    """
    source, id_type = _source(docs, id_col, text_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        encoder = pair_encoder(path_a, path_b)
        writer = Writer(len(encoder.entries[0]), len(encoder.entries[1]))
        width = "<u2" if max(map(len, encoder.entries)) <= 1 << 16 else "<u4"
        for batch in batches:
            for start, stop, texts in _chunks(batch):
                a, b = encoder.pair(texts)
                last_a, last_b = ending_together(a, b, overlaps(a, b))
                codes, of = writer.codes(a, b, last_a, last_b), a.offsets + b.offsets
                of_group = np.searchsorted(last_a, a.offsets)
                pairs = np.stack([a.ids[last_a], b.ids[last_b]], axis=1).astype(width)
                digest = [hashlib.sha256(writer.text(codes[x:y]).encode()).hexdigest() if y > x else ""
                          for x, y in zip(of[:-1], of[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("_id").slice(start, stop - start), pa.array(np.diff(a.offsets)), pa.array(np.diff(b.offsets)),
                    pa.array(np.diff(of_group)), pa.array(digest, pa.string()),
                    pa.array([pairs[x:y].tobytes() for x, y in zip(of_group[:-1], of_group[1:])], pa.binary())],
                    names=["_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return source.mapInArrow(run, f"_id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary") \
        .withColumnRenamed("_id", id_col)


def _pairs(batch):
    """The id pairs of a batch of the link table, each as one number, and where each row's begin."""
    import numpy as np
    of = np.append(0, np.cumsum(batch.column("n_groups").to_numpy()))   # as many links as groups
    data = b"".join(batch.column("links").to_pylist())
    ids = np.frombuffer(data, f"<u{max(2, len(data) // max(1, 2 * int(of[-1])))}").reshape(-1, 2).astype(np.uint64)
    return ids[:, 0] << np.uint64(32) | ids[:, 1], of


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, n) per id pair: links of the whole corpus that hold it. Tallied per batch before the shuffle."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            pair, n = np.unique(_pairs(batch)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    tallied = linked.select("n_groups", "links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return tallied.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")


def align_documents(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``n_best`` counts the links whose pair is, over the corpus, the commonest
    of its B id (ties included), ``count_sum`` adds up the links' counts over
    the corpus. Texts are encoded and aligned once; the links go through a
    written table, and the pair counts, bounded by the two vocabularies
    (``pair_bound``), go to the workers. Cases as in ``alignments``; documents
    without tokens have zeros.
    """
    spark = docs.sparkSession
    linked = table(links(docs, path_a, path_b, id_col=id_col, text_col=text_col), "align-links")
    id_type = linked.schema[id_col].dataType.simpleString()
    counted = pair_counts(linked)
    top = counted.groupBy("b").agg(F.max("n").alias("_top")).withColumnRenamed("b", "_b")
    ranked = counted.join(top, F.col("b") == F.col("_b")).select("a", "b", "n", (F.col("n") == F.col("_top")).alias("best"))
    known = spark.sparkContext.broadcast(_sorted_counts(ranked))   # at most pair_bound rows

    def run(batches):
        import numpy as np
        import pyarrow as pa
        pair, n, best = known.value
        for batch in batches:
            for start in range(0, batch.num_rows, COUNT_ROWS):
                part = batch.slice(start, COUNT_ROWS)
                held, of = _pairs(part)
                at = np.searchsorted(pair, held)
                sums = [np.append(0, np.cumsum(v[at])) for v in (best, n)]
                kept = [part.column(c) for c in (id_col, "n_a", "n_b", "n_groups")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(of)), *(pa.array(s[of[1:]] - s[of[:-1]]) for s in sums),
                                                  part.column("groups_sha256")], names=names)

    names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    longs = ", ".join(f"{c} long" for c in names[1:-1])
    return linked.mapInArrow(run, f"`{id_col}` {id_type}, {longs}, groups_sha256 string")


def _sorted_counts(ranked: DataFrame) -> tuple:
    """Pairs as numbers in ascending order, their counts, and whether they are their B id's commonest."""
    import numpy as np
    got = ranked.toArrow()
    pair = got.column("a").to_numpy().astype(np.uint64) << np.uint64(32) | got.column("b").to_numpy().astype(np.uint64)
    order = np.argsort(pair)
    return pair[order], got.column("n").to_numpy()[order], got.column("best").to_numpy()[order].astype(np.int64)
