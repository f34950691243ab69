"""Prefix trie of conversations: which turns conversations share from their start, and what sharing them saves.

Different turns (role and text) are numbered by a dictionary, so that a
conversation is a path of turn ids. Different paths are dealt into ranges of
their order. Within a range, shards of bounded size are built as ternary
search trees, balanced by inserting the median path first, and walked
without recursion to sum up members, leaves and savings. Only the nodes on
a shard's first and last path may go on in its neighbours: these boundary
nodes are merged, first along a range, then range by range in rounds of
bounded fan-in. All other nodes are final where they were built.

A conversation's path (8 bytes a turn, no texts) meets in one row. A node's
digest is over its members' ids one after the other, as a digest is, but
from pieces of bounded size. No other group meets in one task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table

#: Different paths of a range, turns of a shard, ids in a piece of a digest, summaries merged at once.
RANGE_PATHS, SHARD_TURNS, PIECE_IDS, FAN = 200_000, 400_000, 50_000, 32
OUT_ROWS = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- turns and paths ---------------------------------------------------------------------------------------------

def encode_turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(conv_id, turns) per conversation, in order of turn (null first; ties by role, then text): an array of (id, words),
    the dictionary number of the turn's role and text and the words of its text.

    Null roles and texts are empty; rows without a conversation id are left
    out; repeated rows are turns of their own; other columns are left out.
    Numbers differ from run to run, what they stand for does not.
    """
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("_at"),
                                F.coalesce(F.col(role_col), F.lit("")).alias("_role"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("_text")).filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("_at").asc_nulls_first(), "_role", "_text")
    coded = table(rows.select(
        "conv_id", F.row_number().over(order).alias("k"),
        F.unhex(F.sha2(F.concat(F.length("_role"), F.lit(":"), "_role", "_text"), 256)).alias("code"),
        F.regexp_count("_text", F.lit(WORD)).cast("long").alias("words")), "trie-turns")
    # Numbered as the rows are written: a number is fixed once its file is committed.
    dictionary = table(coded.select("code").distinct().withColumn("id", F.monotonically_increasing_id()), "trie-dictionary")
    return coded.join(dictionary, "code").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("k", "id", "words"))).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def member_paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, path, words) from (conv_id, turns)."""
    return sequences.select("conv_id", F.col("turns.id").alias("path"), F.col("turns.words").alias("words"))


def distinct_paths(members: DataFrame, parts: int, piece: int = PIECE_IDS) -> DataFrame:
    """(path, words, n, best, ends) per different path: its members, the smallest of them, and the SHA-256 of their ids in
    ascending order, joined by commas.

    Members are dealt by path and id, so those of a common path lie in many
    ranges and travel on as text, one row for ``piece`` of them.
    """
    def runs(batches):
        from pyspark import TaskContext
        part, seq, held, ids = TaskContext.get().partitionId(), 0, None, []
        out = Rows(RUN)

        def close(whole: bool):
            nonlocal seq
            text = ",".join(map(str, ids))
            out.add(held[0], held[1], part, seq, len(ids), ids[0], None if whole else text,
                    hashlib.sha256(text.encode()).hexdigest() if whole else None)
            seq += 1

        first, opened = True, False   # the first path of a range may begin in the one before, the last one may go on in the next
        for batch in batches:
            for conv, path, words in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "words"))):
                if held is not None and path != held[0]:
                    close(whole=not first and not opened)
                    ids, first, opened = [], False, False
                elif len(ids) == piece:
                    close(whole=False)
                    ids, opened = [], True
                held = path, words
                ids.append(conv)
            yield from out.batches()
        if held is not None:
            close(whole=False)
        yield from out.batches(last=True)

    dealt = members.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = table(dealt.mapInArrow(runs, ddl(RUN)), "trie-runs")

    def joined(batches):
        out, held, total, best, digest = Rows(PATH), None, 0, None, None
        for batch in batches:
            for path, words, n, low, text in zip(*(batch.column(c).to_pylist() for c in ("path", "words", "n", "best", "ids"))):
                if held is None or path != held[0]:
                    if held is not None:
                        out.add(*held, total, best, digest.hexdigest())
                    held, total, best, digest = (path, words), 0, low, hashlib.sha256()
                digest.update((("," if total else "") + text).encode())
                total += n
            yield from out.batches()
        if held is not None:
            out.add(*held, total, best, digest.hexdigest())
        yield from out.batches(last=True)

    pieces = found.filter("ends is null").repartition("path").sortWithinPartitions("path", "part", "seq")
    return found.filter("ends is not null").select(*PATH).unionByName(
        pieces.select("path", "words", "n", "best", "ids").mapInArrow(joined, ddl(PATH)))


RUN = {"path": "array<long>", "words": "array<long>", "part": "int", "seq": "int", "n": "long", "best": "long", "ids": "string",
       "ends": "string"}
PATH = {"path": "array<long>", "words": "array<long>", "n": "long", "best": "long", "ends": "string"}
NODE = {"final": "boolean", "part": "int", "place": "int", "depth": "long", "turn": "long", "words": "long", "n": "long", "best": "long",
        "children": "long", "leaves": "long", "saved": "long", "ends": "string", "on_first": "boolean", "on_last": "boolean",
        "key": "binary", "parent": "long", "parent_key": "binary"}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


class Rows:
    """Rows gathered by column and given out as record batches of bounded size."""

    def __init__(self, columns: dict[str, str]):
        self.columns, self.rows = columns, []

    def add(self, *row) -> None:
        self.rows.append(row)

    def batches(self, last: bool = False) -> Iterator:
        import pyarrow as pa
        if len(self.rows) >= OUT_ROWS or (last and self.rows):
            kinds = {"array<long>": pa.list_(pa.int64()), "long": pa.int64(), "int": pa.int32(), "string": pa.string(),
                     "boolean": pa.bool_(), "binary": pa.binary()}
            for k in range(0, len(self.rows), OUT_ROWS):
                columns = zip(self.columns.values(), zip(*self.rows[k:k + OUT_ROWS]))
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for kind, c in columns], names=list(self.columns))
            self.rows = []


# --- a shard -----------------------------------------------------------------------------------------------------

def median_first(n: int) -> Iterator[int]:
    """The positions 0 to n - 1, each run's median before its halves."""
    spans = [(0, n)]
    while spans:
        low, high = spans.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(middle + 1, high), (low, middle)]


class Tree:
    """Ternary search tree: siblings form a search tree by turn id (low, high), ``under`` leads to a node's children. Node 0
    is the root, the empty path."""

    def __init__(self):
        self.turn, self.words, self.depth, self.above = [-1], [0], [0], [-1]
        self.low, self.high, self.under = [-1], [-1], [-1]

    def child(self, node: int, turn: int, words: int) -> int:
        """The child of a node by its turn, made where it is missing."""
        side, at = self.under, node
        while side[at] >= 0:
            at = side[at]
            if turn == self.turn[at]:
                return at
            side = self.low if turn < self.turn[at] else self.high
        new = side[at] = len(self.turn)
        for column, value in ((self.turn, turn), (self.words, words), (self.depth, self.depth[node] + 1), (self.above, node),
                              (self.low, -1), (self.high, -1), (self.under, -1)):
            column.append(value)
        return new

    def insert(self, path: list[int], words: list[int]) -> list[int]:
        """The nodes of a path, the root first."""
        nodes = [0]
        for turn, count in zip(path, words):
            nodes.append(self.child(nodes[-1], turn, count))
        return nodes

    def walk(self) -> Iterator[int]:
        """Nodes in the order of their paths, a node before its children."""
        yield 0
        todo = [(self.under[0], False)]
        while todo:
            at, now = todo.pop()
            if now:
                yield at
            elif at >= 0:
                todo += [(self.high[at], False), (self.under[at], False), (at, True), (self.low[at], False)]


class Node:
    """What is known of a trie node. ``children``, ``leaves`` and ``saved`` cover the subtrees of its final children."""

    __slots__ = ("depth", "turn", "words", "above", "n", "best", "children", "leaves", "saved", "ends", "on_first", "on_last", "key")

    def __init__(self, depth, turn, words, above, n=0, best=None, children=0, leaves=0, saved=0, ends=None, on_first=False,
                 on_last=False, key=None):
        self.depth, self.turn, self.words, self.above, self.n, self.best = depth, turn, words, above, n, best
        self.children, self.leaves, self.saved, self.ends = children, leaves, saved, ends
        self.on_first, self.on_last, self.key = on_first, on_last, key

    def meet(self, n, best) -> None:
        self.n += n
        self.best = best if self.best is None else min(self.best, best)


def path_keys(path: list[int]) -> list[bytes]:
    """A key for each prefix of a path, the empty one first."""
    digest = hashlib.blake2b(digest_size=24)
    keys = [digest.digest()]
    for turn in path:
        digest.update(turn.to_bytes(8, "little", signed=True))
        keys.append(digest.digest())
    return keys


def settle(nodes: list[Node], out: Rows) -> list[Node]:
    """Close the nodes (each after its parent) that are not on the first or last path: write them and add them to their
    parents. Gives the boundary nodes that stay open."""
    for node in reversed(nodes):
        if not (node.on_first or node.on_last):
            if not node.children:
                node.leaves = 1
            node.saved += (node.n - 1) * node.words
            up = node.above
            if up is not None:
                up.children += 1
                up.leaves += node.leaves
                up.saved += node.saved
    for node in nodes:
        if not (node.on_first or node.on_last):
            up = node.above
            pending = up is not None and (up.on_first or up.on_last)
            out.add(True, None, None, node.depth, None, None, node.n, node.best, node.children, node.leaves, node.saved,
                    node.ends or NO_ENDS, None, None, node.key, None if up is None or pending else up.best,
                    up.key if pending else None)
    return [node for node in nodes if node.on_first or node.on_last]


def shard_nodes(paths: list[tuple], out: Rows) -> list[Node]:
    """Boundary nodes of a shard of ascending rows (path, words, n, best, ends); its other nodes go to ``out``."""
    tree, held = Tree(), [None] * len(paths)
    for k in median_first(len(paths)):
        path, words, *_ = paths[k]
        held[k] = tree.insert(path, words) if k in (0, len(paths) - 1) else tree.insert(path, words)[-1:]
    nodes = [Node(d, t, w, None) for d, t, w in zip(tree.depth, tree.turn, tree.words)]
    for node, above in zip(nodes[1:], tree.above[1:]):
        node.above = nodes[above]
    for at, (_, _, n, best, ends) in zip(held, paths):
        nodes[at[-1]].meet(n, best)
        nodes[at[-1]].ends = ends
    for at, mark in ((held[0], "on_first"), (held[-1], "on_last")):
        for k, key in zip(at, path_keys(paths[0 if mark == "on_first" else -1][0])):
            setattr(nodes[k], mark, True)
            nodes[k].key = key
    ordered = [nodes[k] for k in tree.walk()]
    for node in reversed(ordered):
        if node.above is not None:
            node.above.meet(node.n, node.best)
    return settle(ordered, out)


def merge(parts: Iterable[list[Node]], out: Rows, whole: bool = False) -> list[Node]:
    """Boundary nodes of neighbouring summaries in ascending order as one summary; those that are inside now go to ``out``,
    with ``whole`` all of them."""
    parts = [p for p in parts if p]
    nodes: list[Node] = []
    below: dict[int, dict[int, Node]] = {}
    for k, part in enumerate(parts):
        line: list[Node] = []
        for node in part:
            above = line[node.depth - 1] if node.depth else None
            siblings = below.setdefault(id(above) if above else 0, {})
            same = siblings.get(node.turn)
            if same is None:
                same = siblings[node.turn] = Node(node.depth, node.turn, node.words, above, key=node.key)
                nodes.append(same)
            same.meet(node.n, node.best)
            same.children += node.children
            same.leaves += node.leaves
            same.saved += node.saved
            same.ends = same.ends or node.ends
            same.on_first |= node.on_first and k == 0 and not whole
            same.on_last |= node.on_last and k == len(parts) - 1 and not whole
            line[node.depth:] = [same]
    return settle(nodes, out)


def add_open(nodes: list[Node], part: int, out: Rows) -> None:
    for place, node in enumerate(nodes):
        out.add(False, part, place, node.depth, node.turn, node.words, node.n, node.best, node.children, node.leaves, node.saved,
                node.ends, node.on_first, node.on_last, node.key, None, None)


# --- all ranges --------------------------------------------------------------------------------------------------

def trie_nodes(sequences: DataFrame, *, range_paths: int = RANGE_PATHS, shard_turns: int = SHARD_TURNS, piece_ids: int = PIECE_IDS,
               fan: int = FAN) -> DataFrame:
    """One row per different prefix of the sequences (conv_id, turns), the empty one included: ``conv_id`` (smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversation ids must be different and not null; a sequence may be
    empty and then is a member of the root alone. Without sequences there
    are no nodes. Equal sequences are members of the same nodes.
    """
    members = table(member_paths(sequences), "trie-members")
    parts = max(1, math.ceil(members.count() / range_paths))
    paths = table(distinct_paths(members, parts, piece_ids), "trie-paths")
    parts = max(1, math.ceil(paths.count() / range_paths))

    def shards(batches):
        from pyspark import TaskContext
        out, held, rows, turns = Rows(NODE), [], [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in PATH)):
                if rows and turns + len(row[0]) > shard_turns:
                    held, rows, turns = merge([held, shard_nodes(rows, out)], out), [], 0
                    yield from out.batches()
                rows.append(row)
                turns += len(row[0])
        if rows:
            held = merge([held, shard_nodes(rows, out)], out)
        add_open(held, TaskContext.get().partitionId(), out)
        yield from out.batches(last=True)

    def merging(whole: bool):
        def run(rows):
            import pyarrow as pa
            rows = rows.sort_by([("part", "ascending"), ("place", "ascending")]).to_pylist()
            summaries: dict[int, list[Node]] = {}
            for r in rows:
                summaries.setdefault(r["part"], []).append(Node(
                    r["depth"], r["turn"], r["words"], None, r["n"], r["best"], r["children"], r["leaves"], r["saved"], r["ends"],
                    r["on_first"], r["on_last"], r["key"]))
            out = Rows(NODE)
            add_open(merge(summaries.values(), out, whole), rows[0]["part"] // fan, out)
            return pa.Table.from_batches(list(out.batches(last=True)))
        return run

    level = table(paths.repartitionByRange(parts, "path").sortWithinPartitions("path").mapInArrow(shards, ddl(NODE)), "trie-nodes")
    nodes = level.filter("final")
    while True:
        top = level.filter("not final").agg(F.max("part")).first()[0]
        if top is None:
            break
        level = table(level.filter("not final").groupBy(F.floor(F.col("part") / fan)).applyInArrow(
            merging(whole=top < fan), ddl(NODE)), "trie-nodes")
        nodes = nodes.unionByName(level.filter("final"))
    # Children of boundary nodes learn their parent's smallest member from the merged node.
    parents = nodes.filter("key is not null").select(F.col("key").alias("_key"), F.col("best").alias("_best"))
    known = nodes.filter("parent_key is null").withColumn("parent_conv_id", F.col("parent"))
    late = nodes.filter("parent_key is not null").join(parents, F.col("parent_key") == F.col("_key")) \
        .withColumn("parent_conv_id", F.col("_best")).drop("_key", "_best")
    return known.unionByName(late).select(
        F.col("best").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **names) -> DataFrame:
    """``trie_nodes`` of a table of turns; cases as in ``encode_turns``."""
    return trie_nodes(table(encode_turns(conversations, **names), "trie-sequences"))


def with_shared_heads(sequences: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Sequences whose first h turns come from the conversation with the id c - c % ``every`` (all if it has fewer, none if
    it is absent), followed by their own turns after the first h; h is the unsigned crc32 of the id's decimal digits,
    modulo ``heads``."""
    base = sequences.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, heads - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    head = F.when(F.col("_head").isNotNull(), F.slice("_head", F.lit(1), h)).otherwise(F.slice("turns", F.lit(1), F.lit(0)))
    return sequences.join(base, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left").select(
        "conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))
