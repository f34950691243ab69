"""Chat formatting from reply trees, in DataFrame operations only.

Messages point to the message they answer. Self-joins with pointer doubling
carry every message to its root: round k joins each message with its ancestor
2^k levels up, so a thread of depth d needs about log2(d) rounds. Leaves are
ranked by the score of their root-to-leaf path, and the same jump tables, read
downwards, list the messages of each chosen path. A path becomes one text with
turn marks and a loss mask over the assistant's turns.

Control strings inside a text get one more backslash after their opening
bracket (any that stand there already are counted), and lose one when read
back, so every text survives the round trip and can never end a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

# The turn marks. Other roles than these three are written by name, percent-encoded.
MARKS = {"system": ("<<SYS>> ", " <</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER_OPEN, OTHER_CLOSE = "[ROLE:{}] ", " [/ROLE]"
CONTROL = r"(\[/?|<</?|</?)(\\*)(INST\]|ROLE[:\]]|SYS>>|s>)"
CONTROL_ESCAPED = r"(\[/?|<</?|</?)\\(\\*)(INST\]|ROLE[:\]]|SYS>>|s>)"
TURN = r"(?s)<<SYS>> .*? <</SYS>>|\[INST\] .*? \[/INST\]|<s> .*? </s>|\[ROLE:[^\]]*\] .*? \[/ROLE\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$1\\$2$3"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL_ESCAPED), F.lit("$1$2$3"))


def linear_replies(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Rows by turn as reply trees without branches: each turn answers the one before it.

    Repeated turn numbers are ordered by role, then text (nulls first). Rows
    with a null conversation id form one conversation. A conversation becomes
    one output row, so its turns meet in one task here as they do there.
    """
    w = Window.partitionBy("tree").orderBy(F.col(turn_col).asc_nulls_first(), F.col(role_col).asc_nulls_first(),
                                           F.col(text_col).asc_nulls_first())
    keyed = turns.select(F.col(conv_col).alias("tree"), turn_col, role_col, text_col)
    return keyed.withColumn("msg", F.row_number().over(w).cast("long")).select(
        "tree", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.lit(1.0).alias("score"))


def reply_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, path, pos, msg) of the ``top`` best root-to-leaf paths of every tree.

    ``messages``: tree, msg (unique in its tree, not null), parent, score. The
    score of a path is the sum over its messages (null scores count 0); ties go
    to the smaller leaf. A parent that is null or missing makes a root.
    Messages on a cycle have no root and so belong to no path. ``path`` is the
    leaf's msg, ``pos`` counts from 0 at the root.
    """
    tree, same = F.col("tree"), lambda a, b: F.col(a).eqNullSafe(F.col(b))
    nodes = messages.select("tree", "msg", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = nodes.select(tree.alias("_t"), F.col("msg").alias("_m"))
    nodes = table(nodes.join(known, same("tree", "_t") & (F.col("parent") == F.col("_m")), "left")
                  .select("tree", "msg", F.col("_m").alias("anc"), F.col("score").alias("sum"),
                          F.lit(1).cast("long").alias("len")), "chat-nodes")
    parents = nodes.filter("anc is not null").select(tree.alias("_t"), F.col("anc").alias("_m")).distinct()
    done = nodes.filter("anc is null")
    jumps, open_, limit = [], nodes.filter("anc is not null"), nodes.count()
    while 2 ** len(jumps) <= limit and not open_.isEmpty():
        jumps.append(open_)
        above = open_.unionByName(done).select(tree.alias("_t"), F.col("msg").alias("_m"), F.col("anc").alias("_anc"),
                                               F.col("sum").alias("_sum"), F.col("len").alias("_len"))
        step = table(open_.join(above, same("tree", "_t") & (F.col("anc") == F.col("_m")))
                     .select("tree", "msg", F.col("_anc").alias("anc"), (F.col("sum") + F.col("_sum")).alias("sum"),
                             (F.col("len") + F.col("_len")).alias("len")), "chat-jump")
        done = done.unionByName(step.filter("anc is null"))
        open_ = step.filter("anc is not null")

    leaves = done.join(parents, same("tree", "_t") & (F.col("msg") == F.col("_m")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("sum"), "msg"))
    paths = leaves.withColumn("_rank", rank).filter(F.col("_rank") <= top) \
        .select("tree", F.col("msg").alias("path"), "msg", (F.col("len") - 1).alias("pos"))
    for k in reversed(range(len(jumps))):
        up = jumps[k].select(tree.alias("_t"), F.col("msg").alias("_m"), F.col("anc").alias("_anc"))
        higher = paths.join(up, same("tree", "_t") & (F.col("msg") == F.col("_m"))) \
            .select("tree", "path", F.col("_anc").alias("msg"), (F.col("pos") - 2 ** k).alias("pos"))
        paths = table(paths.unionByName(higher), "chat-paths")
    return paths


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: tree, path, ``formatted`` and ``loss_spans`` (code-point start and end of every assistant text)."""
    m = messages.select(F.col("tree").alias("_t"), F.col("msg").alias("_m"), "role", "text")
    rows = paths.join(m, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("msg") == F.col("_m")))
    opening = F.concat(F.lit("[ROLE:"), F.url_encode("role"), F.lit("] "))
    closing = F.lit(OTHER_CLOSE)
    for role, (a, b) in MARKS.items():
        opening = F.when(F.col("role") == role, F.lit(a)).otherwise(opening)
        closing = F.when(F.col("role") == role, F.lit(b)).otherwise(closing)
    rows = rows.select("tree", "path", "pos", "role", opening.alias("_a"), escape(F.col("text")).alias("_e"),
                       closing.alias("_b")) \
        .withColumn("_piece", F.concat("_a", "_e", "_b"))
    before = Window.partitionBy("tree", "path").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum(F.length("_piece").cast("long")).over(before), F.lit(0))
                           + F.length("_a")) \
        .withColumn("_span", F.when(F.col("role") == "assistant", F.struct(
            F.col("_start").alias("start"), (F.col("_start") + F.length("_e")).alias("end"))))
    turns = rows.groupBy("tree", "path").agg(
        F.sort_array(F.collect_list(F.struct("pos", "_piece", "_span"))).alias("_turns"))
    return turns.select(
        "tree", "path", F.array_join(F.transform("_turns", lambda t: t["_piece"]), "").alias("formatted"),
        F.transform(F.filter("_turns", lambda t: t["_span"].isNotNull()), lambda t: t["_span"]).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    def one(turn: Column) -> Column:
        role = F.url_decode(F.regexp_extract(turn, r"^\[ROLE:([^\]]*)\] ", 1))
        head, tail = F.length(F.regexp_extract(turn, r"^\[ROLE:[^\]]*\] ", 0)), len(OTHER_CLOSE)
        text = F.substring(turn, head + 1, F.length(turn) - head - tail)
        for name, (a, b) in MARKS.items():
            mine = F.startswith(turn, F.lit(a))
            role = F.when(mine, F.lit(name)).otherwise(role)
            text = F.when(mine, F.substring(turn, F.lit(len(a) + 1), F.length(turn) - len(a) - len(b))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))
    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), one)


def read_loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def format_conversations(turns: DataFrame, **columns) -> DataFrame:
    """Rows by turn → one formatted conversation each: conv_id, formatted, loss_spans.

    Null turns come first, ties in order of role and text (null first), so
    repeated rows are turns of their own; null roles and texts are empty; rows
    with a null id are one conversation. Other columns are left out, whatever
    their names; an empty table gives none.
    """
    messages = table(linear_replies(turns, **columns), "chat-messages")
    out = format_paths(messages, reply_paths(messages, top=1))
    return out.select(F.col("tree").alias(columns.get("conv_col", "conv_id")), "formatted", "loss_spans")
