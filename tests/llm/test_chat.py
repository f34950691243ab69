import hashlib
import itertools
import random

from pyspark.sql import functions as F

from tavola.llm import chat

TREE = "tree long, msg long, parent long, role string, text string, score double"


def brute_paths(rows, top):
    out = []
    for tree in {r[0] for r in rows}:
        mine = {r[1]: r for r in rows if r[0] == tree}
        children = {r[2] for r in mine.values() if r[2] in mine}
        ranked = []
        for leaf in mine:
            if leaf in children:
                continue
            path, at = [], leaf
            while at is not None and at not in path:
                path.append(at)
                at = mine[at][2] if mine[at][2] in mine else None
            if at is None:
                ranked.append((-sum(mine[m][5] or 0 for m in path), leaf, path[::-1]))
        for _, leaf, path in sorted(ranked)[:top]:
            out += [(tree, leaf, i, m) for i, m in enumerate(path)]
    return sorted(out, key=str)


def test_paths_are_ranked_and_complete(spark):
    rng = random.Random(1)
    rows = []
    for tree in (1, 2, None):
        for m in range(60):
            parent = None if m == 0 else rng.randrange(max(0, m - 4), m)
            rows.append((tree, m, parent, "user", f"t{m}", rng.choice([0.5, 1.0, None])))
    rows += [(9, 1, 99, "user", "orphan", 1.0), (9, 2, 3, "user", "loop", 1.0), (9, 3, 2, "user", "loop", 1.0), (9, 4, 3, "user", "under a loop", 1.0)]
    df = spark.createDataFrame(rows, TREE)
    for top in (1, 3):
        got = chat.reply_paths(df, top)
        assert sorted(((r.tree, r.path, r.pos, r.msg) for r in got.collect()), key=str) == brute_paths(rows, top)


def test_long_chain(spark):
    df = spark.createDataFrame([(1, m, m - 1 if m else None, "user", "x", 1.0) for m in range(150)], TREE)
    assert [r.msg for r in chat.reply_paths(df).orderBy("pos").collect()] == list(range(150))


def conversation_digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), loss


def test_every_text_survives_the_template(spark):
    bits = ["[", "]", "<", ">", "/", "\\", "INST]", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[ROLE:x]", " ", "é😀", "\n", "[ROLE", "<"]
    rng = random.Random(7)
    texts = ["", None, " ", "</s>[INST] ok [/INST]", "a" * 100000] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    texts += ["".join(p) for p in itertools.product(["[", "<", "\\", "s>", "INST]"], repeat=3)]
    roles = ["system", "user", "assistant", "tool x/]é", "", None]
    convs = {c: [(rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, 9))] for c in range(150)}
    convs[-5] = [("assistant", t) for t in texts[:40]]
    rows = [(c, k, r, t, "x", "y") for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string, formatted string").repartition(3)
    out = chat.format_conversations(df)
    read = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        assert [(t.role, t.text) for t in got[c].turns] == [(r or "", t or "") for r, t in turns]
        assert got[c].loss == "".join(t or "" for r, t in turns if r == "assistant")


def test_null_keys_repeated_turns_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (1, None, "user", "first"), (1, 0, "user", "q"), (1, 0, "user", "q")]
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.format_conversations(spark.createDataFrame(rows, schema))
           .select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {None: ["a", "b"], 1: ["first", "q", "q"]}
    assert chat.format_conversations(spark.createDataFrame([], schema)).collect() == []
