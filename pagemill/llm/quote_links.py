"""Quotation linking for chat formatting, in DataFrame operations only.

The lines of a message have a quote level, the number of ``>`` marks they begin with. Quoted lines are normalised
(marks off, lower case, white space collapsed), hashed and joined to the messages that first said them: in the same
conversation, else anywhere. The message with the most quoted characters at the lowest linked level is what a message
replies to. Replies only point to earlier messages, so they form trees; their roots and depths are found by pointer
doubling. Ordered by thread and position, every message comes after what it replies to, and quotes are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.common import stored

_MARKS = r"^(?:[ \t]*>)+"


def level_of(line: Column) -> Column:
    """Number of quote marks a line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", ""))


def normalised(line: Column) -> Column:
    """What is compared: no marks, lower case, single blanks."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\s+", " ")))


def _message(row: str = "conv_id", turn: str = "turn") -> Column:
    return F.struct(F.col(row).alias("conv_id"), F.col(turn).alias("turn"))


def quoted_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, line, level, hash, length) of every line that isn't blank; level 0 is the message's own."""
    line = messages.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line", "raw")
    )
    line = line.withColumn("level", level_of(F.col("raw"))).withColumn("said", normalised(F.col("raw"))).where("said <> ''")
    return line.select("conv_id", "turn", "line", "level", F.sha2("said", 256).alias("hash"), F.length("said").alias("length"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, line, length, source): the earliest earlier message that said a quoted line itself."""
    lines = quoted_lines(messages)
    own, quoted = lines.where("level = 0"), lines.where("level > 0").distinct()
    # One row for each key on this side, so a hot line doesn't multiply; a hot key on the other side can be split.
    near = own.groupBy("conv_id", "hash").agg(F.min("turn").alias("near"))
    far = own.groupBy("hash").agg(F.min(_message()).alias("far"))
    found = quoted.join(near, ["conv_id", "hash"], "left").join(far, "hash", "left")
    source = F.when(F.col("near") < F.col("turn"), _message("conv_id", "near")).when(F.col("far") < _message(), F.col("far"))
    return found.withColumn("source", source).select("conv_id", "turn", "level", "line", "length", "source")


def replies(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, n_quoted, n_linked, levels): what each message with quotes replies to."""
    known = links.where("source is not null")
    votes = known.groupBy("conv_id", "turn", "level", "source").agg(F.sum("length").alias("chars"))
    # Lowest level, then most characters, then the latest message.
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "chars", "source")).alias("best"))
    counted = links.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quoted"), F.count("source").alias("n_linked"), F.max("level").alias("levels")
    )
    return counted.join(best, ["conv_id", "turn"], "left").select("conv_id", "turn", F.col("best.source").alias("parent"), "n_quoted", "n_linked", "levels")


def threads(parents: DataFrame) -> DataFrame:
    """(message, root, depth) of the messages with a parent (message, parent); a round doubles the steps taken."""
    now = stored(parents.select("message", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        above = now.select(F.col("message").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        after = stored(now.join(above, "root", "left").select(
            "message", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("above").isNotNull().alias("moved"),
        ))
        if after.where("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, thread_conv, thread_turn, depth, parent_conv, parent_turn, levels,
    n_quoted, n_linked and body (the text without quoted lines).

    Reply order is (thread_conv, thread_turn, conv_id, turn): a message comes after what it replies to. A message
    without a linked quote starts a thread. A null text has a null body; null conv_id or turn take part in nothing;
    repeated rows keep a row each; of several texts under one conv_id and turn all lines count. A line quoted from
    nowhere is counted in n_quoted only. An empty table gives an empty result.
    """
    linked = stored(replies(link_quotes(messages)))
    of_parent = linked.where("parent is not null").select(_message().alias("message"), "parent")
    rooted = threads(of_parent).select(
        F.col("message.conv_id").alias("conv_id"), F.col("message.turn").alias("turn"), "root", "depth"
    )
    known = linked.join(rooted, ["conv_id", "turn"], "left")
    body = F.array_join(F.filter(F.split("text", "\n"), lambda line: level_of(line) == 0), "\n")
    return messages.select("conv_id", "turn", "role", F.when(F.col("text").isNotNull(), body).alias("body")).join(
        known, ["conv_id", "turn"], "left"
    ).select(
        "conv_id", "turn", "role", F.coalesce("root.conv_id", "conv_id").alias("thread_conv"), F.coalesce("root.turn", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.col("parent.conv_id").alias("parent_conv"), F.col("parent.turn").alias("parent_turn"),
        F.coalesce("levels", F.lit(0)).alias("levels"), F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "body",
    )
