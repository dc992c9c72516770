"""Chat formatting by quotation linking, in DataFrame functions only.

A line's quote level is the number of ``>`` marks before its content (each may
be followed by one space). A passage is a run of lines of one level without an empty one.
Passages, and their single lines, are normalised (A-Z to lower case, runs of blanks
and line ends to one space, ends trimmed) and hashed, so a passage that was wrapped anew
is known, and so is one quoted in part. A quoted hash is joined to the first earlier message of its conversation
that holds it unquoted. The message with most matches at the lowest matching level is the parent;
ties go to the later message. A message without a match starts a thread.
Threads are followed by pointer jumping, so a reply chain of length n takes
log2(n) rounds.

Result: one row per message, quotes removed, with the keys of its place:
``thread_root`` (turn of the first message), ``depth`` (replies from there),
``parent_turn`` and ``position``: ordering by (conv_id, thread_root, position) puts each
reply, with all replies to it, right behind its parent, siblings by turn. Positions
come from the thread's tour (down and up each branch), ranked by pointer
jumping, so neither depth nor breadth makes a long row. ``transcripts`` joins the rendered
messages in that order, a bounded number to a row. A conversation is never
gathered into one row, however long it is; only the siblings of one message are sorted together.

Defined cases: null text is empty; empty quoted lines link nothing; a null
conversation or turn takes no part in linking and stands as its own thread; rows that
repeat a (conversation, turn) count as one message for linking and are all
returned; a line quoted by its own or an earlier message does not link; a null
role renders as ``user``; an empty table gives an empty result. Only the four
named columns are read, so further columns cannot clash. Messages of any length are parsed whole, in time
linear in their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelens.llm.common import BLANKS, checkpoint, salted_join

UNIT = "struct<level:int,content:string>"
MARKS = r"^(?:>\x20?)*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"\x20", ""))


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(line, MARKS, ""), UPPER, LOWER), BLANKS, " "))


def _units(raw: Column) -> Column:
    """The lines of a message that are not empty, and its passages, each as (level, content)."""
    lines = F.transform(raw, lambda x: F.struct(_level(x).alias("level"), _normal(x).alias("content")).cast(UNIT))

    def breaks(held: Column, i: Column, j: Column) -> Column:
        """Whether line ``i`` stands apart from its neighbour ``j``."""
        here, there = F.get(held, i), F.get(held, j)
        return (j < 0) | there.isNull() | (there["content"] == "") | (there["level"] != here["level"])

    def gathered(held: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: F.get(held, i)["content"] != "")
        first, last = F.filter(full, lambda i: breaks(held, i, i - 1)), F.filter(full, lambda i: breaks(held, i, i + 1))
        runs = F.zip_with(first, last, lambda a, b: F.struct(
            F.get(held, a)["level"].alias("level"),
            F.array_join(F.transform(F.slice(held, a + 1, b - a + 1), lambda x: x["content"]), " ").alias("content")).cast(UNIT))
        return F.concat(F.filter(held, lambda x: x["content"] != ""), runs)

    # bound as a lambda variable: the lines are parsed once, then read by index
    return F.get(F.transform(F.array(lines), gathered), F.lit(0))


def parse(messages: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, level, hash of its lines and passages (not distinct)."""
    raw = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    known = messages.where("conv_id is not null and turn is not null")
    return (known.select("conv_id", "turn", F.explode(_units(raw)).alias("u"))
            .select("conv_id", "turn", "u.level", F.sha2("u.content", 256).alias("hash")))


def links(messages: DataFrame) -> DataFrame:
    """Per replying message: conv_id, turn, parent_turn, n_linked (lines and passages)."""
    units = parse(messages)
    quoted = units.where("level > 0").distinct()
    firsts = units.where("level = 0").groupBy("conv_id", "hash").agg(F.min("turn").alias("parent_turn"))
    votes = (quoted.join(firsts, ["conv_id", "hash"]).where("parent_turn < turn")
             .groupBy("conv_id", "turn", "level", "parent_turn").agg(F.count(F.lit(1)).alias("n")))
    best = F.max(F.struct((-F.col("level")).alias("l"), "n", "parent_turn"))
    return (votes.groupBy("conv_id", "turn").agg(best.alias("b"))
            .select("conv_id", "turn", F.col("b.parent_turn").alias("parent_turn"), F.col("b.n").alias("n_linked")))


def threads(parents: DataFrame) -> DataFrame:
    """``parents`` with thread_root and depth, by pointer jumping."""
    nodes = checkpoint(parents.select("*", F.col("parent_turn").alias("thread_root"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = nodes.select("conv_id", F.col("turn").alias("thread_root"), F.col("thread_root").alias("up_root"),
                          F.col("depth").alias("up_depth"))
        joined = nodes.join(up, ["conv_id", "thread_root"], "left")
        if joined.where("up_root is not null").isEmpty():
            return nodes
        nodes = checkpoint(joined.select(
            "conv_id", "turn", "parent_turn", "n_linked", F.coalesce("up_root", "thread_root").alias("thread_root"),
            (F.col("depth") + F.coalesce("up_depth", F.lit(0))).alias("depth")))


def positions(placed: DataFrame) -> DataFrame:
    """conv_id, turn, position of every message in a thread of two or more:
    its place in the thread, depth first."""
    replies = placed.select("conv_id", "turn", "parent_turn")
    sibling = F.lead("turn").over(Window.partitionBy("conv_id", "parent_turn").orderBy("turn"))
    replies = replies.withColumn("sibling", sibling)
    nodes = replies.unionByName(placed.where("depth = 1").select("conv_id", F.col("thread_root").alias("turn")).distinct()
                                .withColumns({"parent_turn": F.lit(None).cast("long"), "sibling": F.lit(None).cast("long")}))
    child = replies.groupBy("conv_id", F.col("parent_turn").alias("turn")).agg(F.min("turn").alias("child"))
    nodes = nodes.join(child, ["conv_id", "turn"], "left")
    # the tour goes down to a message and up from it; ``up`` 0 or 1 tells which
    down = F.struct(F.lit(0).alias("up"), F.coalesce("child", "turn").alias("to"), F.when(F.col("child").isNull(), 1).otherwise(0).alias("to_up"),
                    F.lit(1).cast("long").alias("n"))
    up = F.struct(F.lit(1).alias("up"), F.coalesce("sibling", "parent_turn").alias("to"),
                  F.when(F.col("sibling").isNull(), 1).otherwise(0).alias("to_up"), F.lit(0).cast("long").alias("n"))
    steps = checkpoint(nodes.select("conv_id", "turn", F.explode(F.array(down, up)).alias("s")).select("conv_id", "turn", "s.*"))
    while True:
        ahead = steps.select("conv_id", F.col("turn").alias("to"), F.col("up").alias("to_up"), F.col("to").alias("next"),
                             F.col("to_up").alias("next_up"), F.col("n").alias("more"))
        joined = steps.join(ahead, ["conv_id", "to", "to_up"], "left")
        if steps.where("to is not null").isEmpty():
            break
        steps = checkpoint(joined.select("conv_id", "turn", "up", F.col("next").alias("to"), F.col("next_up").alias("to_up"),
                                         (F.col("n") + F.coalesce("more", F.lit(0))).alias("n")))
    left = steps.where("up = 0").select("conv_id", "turn", "n")  # messages from here to the end of the tour
    roots = placed.select("conv_id", "turn", "thread_root").join(
        left.select("conv_id", F.col("turn").alias("thread_root"), F.col("n").alias("all")), ["conv_id", "thread_root"])
    return roots.join(left, ["conv_id", "turn"]).select("conv_id", "turn", (F.col("all") - F.col("n")).alias("position"))


def transcripts(formatted: DataFrame, messages: int = 64) -> DataFrame:
    """conv_id, thread_root, part, chat: the rendered messages of each thread in
    order, ``messages`` positions to a row."""
    part = F.floor(F.col("position") / messages).cast("long").alias("part")
    held = F.array_sort(F.collect_list(F.struct("position", "turn", "chat")))
    out = formatted.groupBy("conv_id", "thread_root", part).agg(held.alias("m"))
    return out.select("conv_id", "thread_root", "part", F.array_join(F.transform("m", lambda x: x["chat"]), "").alias("chat"))


def unquoted(text: Column) -> Column:
    """The lines of level 0, without blank lines at the ends."""
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: ~x.startswith(">"))
    return F.regexp_replace(F.array_join(kept, "\n"), r"\A\n+|\n+\z", "")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("user")), F.lit("|>\n"), text, F.lit("\n"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, role, parent_turn, thread_root, depth, position,
    n_linked, text (without quotes) and chat (the rendered message)."""
    messages = conversations.select("conv_id", "turn", "role", "text")
    placed = threads(links(messages))
    placed = placed.join(positions(placed), ["conv_id", "turn"])
    out = salted_join(messages, placed, ["conv_id", "turn"], ["text"], "left")
    text = unquoted(F.col("text"))
    return out.select("conv_id", "turn", "role", "parent_turn", F.coalesce("thread_root", "turn").alias("thread_root"),
                      F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
                      F.coalesce("position", F.lit(0)).cast("long").alias("position"),
                      F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                      text.alias("text"), rendered(F.col("role"), text).alias("chat"))
