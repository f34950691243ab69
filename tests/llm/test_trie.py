import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tavola.llm import trie
from tavola.llm.common import table


def brute_nodes(sequences):
    """Rows of trie_nodes from {conv_id: [(turn, words), ...]}."""
    nodes = defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(conv)
    rows = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        ends = sorted(c for c in members if len(sequences[c]) == len(path))
        rows.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                     sum(len(p) == len(path) + 1 for p in under), sum(all(q[:len(p)] != p or q == p for q in under) for p in under),
                     sum((len(nodes[p]) - 1) * p[-1][1] for p in under if p),
                     hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(rows, key=str)


def words(text):
    return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w])


def brute_turns(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [((r, t), words(t)) for _, _, r, t in sorted(v)] for c, v in held.items()}


def rebuilt(sequences, every=20, heads=4):
    out = {}
    for c, own in sequences.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (c % every if c >= 0 else -(-c % every))
        out[c] = sequences.get(base, [])[:h] + own[h:]
    return out


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def chats(seed, n=90):
    rng = random.Random(seed)
    turns = ["hi", "hello there", "", None, "a longer turn\nwith lines", "hi "]
    rows = []
    for c in rng.sample(range(-45, 300), n):
        for k in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, None if rng.random() < .05 else k, rng.choice(["user", "assistant", None]),
                         "hi" if k == 0 and rng.random() < .5 else rng.choice(turns)))
    rows += rows[:20] + [(None, 0, "user", "nobody"), (None, None, None, None), (1000, 0, "user", "word " * 4000)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("sizes", [{}, {"range_paths": 7, "shard_turns": 9, "piece_ids": 2, "fan": 2}, {"range_paths": 30, "piece_ids": 1}])
def test_rebuilt_conversations_match_brute_force(spark, sizes):
    rows = chats(1)
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA + ", path string, n int").repartition(5)
    sequences = trie.with_shared_heads(table(trie.encode_turns(df)))
    want = brute_nodes(rebuilt(brute_turns(rows)))
    assert got(trie.trie_nodes(sequences, **sizes)) == want
    assert any(c[1] == 0 for c in want)


def test_plain_conversations(spark):
    rows = [(c, k, "user", f"{k} {c % 3 if k == 2 else ''}") for c in range(40) for k in range(c % 5)]
    nodes = trie.conversation_trie(spark.createDataFrame([(t, r, k, c) for c, k, r, t in rows],
                                                         "body string, who string, place int, chat int"),
                                   conv_col="chat", turn_col="place", role_col="who", text_col="body")
    assert got(nodes) == brute_nodes(brute_turns(rows))


def test_one_common_path_over_many_ranges(spark):
    """Most conversations are the same; their digest is put together from pieces of many ranges."""
    sequences = {c: [("a", 1), ("b", 2)] if c % 5 else [("a", 1), (f"c{c % 15}", 3)] for c in range(400)}
    number = {t: k for k, t in enumerate(sorted({t for s in sequences.values() for t, _ in s}))}
    df = spark.createDataFrame([(c, [(number[t], w) for t, w in s]) for c, s in sequences.items()],
                               "conv_id long, turns array<struct<id:long,words:long>>")
    assert got(trie.trie_nodes(df, range_paths=20, piece_ids=3, shard_turns=2, fan=2)) == brute_nodes(sequences)


@pytest.mark.parametrize("seed", range(6))
def test_shards_in_any_cut_give_the_same_nodes(seed):
    rng = random.Random(seed)
    paths = sorted({tuple(rng.randint(0, 2) for _ in range(rng.randint(0, 6))) for _ in range(60)})
    sequences = {c: [(t, t + 1) for t in p] for c, p in enumerate(paths)}
    rows = [(list(p), [t + 1 for t in p], 1, c, hashlib.sha256(str(c).encode()).hexdigest()) for c, p in enumerate(paths)]
    out = trie.Rows(trie.NODE)
    cuts = sorted({0, len(rows), *rng.sample(range(len(rows)), 9)})
    parts = [trie.shard_nodes(rows[a:b], out) for a, b in zip(cuts, cuts[1:])]
    half = len(parts) // 2
    trie.merge([trie.merge(parts[:half], out), trie.merge(parts[half:], out)], out, whole=True)
    named = [dict(zip(trie.NODE, r)) for r in out.rows]
    best = {r["key"]: r["best"] for r in named if r["key"] is not None}
    found = [(r["best"], r["depth"], best[r["parent_key"]] if r["parent_key"] else r["parent"], r["n"], r["children"], r["leaves"],
              r["saved"], r["ends"]) for r in named]
    assert sorted(found, key=str) == brute_nodes(sequences)


def test_medians_come_first_and_the_tree_is_balanced():
    assert sorted(trie.median_first(100)) == list(range(100)) and next(trie.median_first(9)) == 4
    tree = trie.Tree()
    for k in trie.median_first(1023):
        tree.insert([k], [1])
    assert [tree.turn[k] for k in tree.walk()][1:] == list(range(1023))

    def steps(turn):
        at, n = tree.under[0], 0
        while tree.turn[at] != turn:
            at, n = (tree.low if turn < tree.turn[at] else tree.high)[at], n + 1
        return n
    assert max(map(steps, range(1023))) <= 10


def test_deep_conversation_needs_no_recursion():
    out = trie.Rows(trie.NODE)
    trie.merge([trie.shard_nodes([(list(range(5000)), [1] * 5000, 3, 0, "x")], out)], out, whole=True)
    assert len(out.rows) == 5001 and max(r[10] for r in out.rows) == 10000


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(trie.conversation_trie(empty)) == []
    assert got(trie.conversation_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []
    one = spark.createDataFrame([(5, None, None, None)], SCHEMA)
    assert got(trie.conversation_trie(one)) == brute_nodes({5: [(("", ""), 0)]})
