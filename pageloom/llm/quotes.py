"""Quotation linking: from mails that quote each other to reply-ordered conversations without quotes.

DataFrame operations only. Lines get their quote level; runs of lines of one level are passages; passages
are compared by a hash of their normalised text; a quoted passage belongs to the first earlier message of
its conversation that has it as own text. A message replies to the latest message quoted on its lowest level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import written

#: Quote marks before a line: up to three blanks, then signs with blanks between them.
MARKS = r"^ {0,3}(>[> ]*)"
#: A line that announces a quote, in the languages of common mail programs.
ANNOUNCES = r"(?i)^\s*(on|am|le|el)\b.*\b(wrote|schrieb|a écrit|escribió)\b.*:\s*$"


def passage_hash(text: Column) -> Column:
    """Equal for passages that differ in case, line breaks and blanks only."""
    return F.md5(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")))


def quote_lines(messages: DataFrame) -> DataFrame:
    """``(conv, turn, msg, text)`` to a row for each line: place, quote level, body and number of its passage;
    ``msg`` tells messages of one turn apart.

    A passage ends at an empty line or where the level changes. Level-0 lines that announce a quote right
    below them are of no passage (number null), like empty lines."""
    lines = messages.select("conv", "turn", "msg", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("place", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    lines = lines.withColumn("level", F.length(F.translate(marks, " ", ""))).withColumn(
        "body", F.trim(F.regexp_replace("line", MARKS, "")))
    order = Window.partitionBy("conv", "turn", "msg").orderBy("place")
    announces = (F.col("level") == 0) & (F.lead("level").over(order) > 0) & F.col("line").rlike(ANNOUNCES)
    lines = lines.withColumn("void", (F.col("body") == "") | F.coalesce(announces, F.lit(False)))
    begins = ~F.col("void") & (
        F.lag("void").over(order).isNull() | F.lag("void").over(order) | (F.lag("level").over(order) != F.col("level")))
    number = F.sum(begins.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("passage", F.when(~F.col("void"), number)).select("conv", "turn", "msg", "place", "level", "body", "passage")


def passages(lines: DataFrame) -> DataFrame:
    """``(conv, turn, msg, passage, level, hash)``; a passage is no longer than its message."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "body"))), lambda x: x["body"]), " ")
    return lines.where("passage is not null").groupBy("conv", "turn", "msg", "passage").agg(
        F.first("level").alias("level"), passage_hash(body).alias("hash"))


def link_quotes(found: DataFrame) -> DataFrame:
    """``(conv, turn, msg, level, hash, origin)`` of quoted passages; ``origin`` null: nobody wrote it before."""
    own = found.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    quoted = found.where("level > 0").select("conv", "turn", "msg", "level", "hash")
    linked = quoted.join(own, ["conv", "hash"], "left")
    return linked.withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))


def threads(replies: DataFrame) -> DataFrame:
    """``(conv, turn, parent)`` with unique places to ``(conv, turn, parent, thread, depth)``.

    Every round doubles the way back that is known, so rounds grow with the logarithm of the depth."""
    now = written(replies.select("conv", "turn", "parent", F.col("parent").alias("up"), F.col("parent").isNotNull().cast("long").alias("depth"), F.coalesce("parent", "turn").alias("thread")), "replies")
    while not now.where("up is not null").isEmpty():
        above = now.where("conv is not null and turn is not null").select(
            "conv", F.col("turn").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"), F.col("thread").alias("thread2"))
        # messages whose first one is known are passed on without a join
        met = now.where("up is not null").join(above, ["conv", "up"], "left").select(
            "conv", "turn", "parent", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            F.coalesce("thread2", "thread").alias("thread"))
        now = written(met.unionByName(now.where("up is null")), "replies")
    return now.select("conv", "turn", "parent", "thread", "depth")


def unquote(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """``(conv_id, turn, parent_turn, thread, depth, n_quotes, n_linked, own_text)``, a row per message.

    ``thread`` is the turn of the first message of a chain of replies and ``depth`` the number of replies
    since, so ordering by conversation, thread, depth and turn puts every message behind the one it answers.
    ``own_text`` has no quoted lines, no lines that announce a quote, and no empty lines at its ends.

    A message is its conversation, turn and text: an exactly repeated row counts once, and texts that share
    a turn are messages of their own but one place in the thread, whose parent is the latest of theirs. A
    null text is empty. Messages with a null conversation or turn are linked with nothing. Conversation and
    turn keep their types; turns are numbers. Other columns are not read. An empty table gives an empty
    result. A passage that only quotes repeat has no origin. Passages, hashes and links are per message or
    per conversation and passage, so a long conversation is not gathered anywhere."""
    rows = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(text_col, F.lit("")).alias("text"))
    # the texts are shuffled once: lines and passages keep to the partitions of their message
    rows = rows.withColumn("msg", F.md5("text")).dropDuplicates(["conv", "turn", "msg"])
    lines = written(quote_lines(rows), "lines")
    linked = written(link_quotes(written(passages(lines), "passages")), "quotes")
    plain = F.transform(F.sort_array(F.collect_list(F.when((F.col("level") == 0) & (F.col("passage").isNotNull() | (F.col("body") == "")), F.struct("place", "body")))), lambda x: x["body"])
    own = lines.groupBy("conv", "turn", "msg").agg(F.regexp_replace(F.array_join(plain, "\n"), r"^\n+|\n+$", "").alias("own_text"))
    per = linked.groupBy("conv", "turn", "msg").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("low"), "origin")))["origin"].alias("parent"))
    keys = [own[c].eqNullSafe(per[c]) for c in ("conv", "turn", "msg")]
    told = own.join(per, keys, "left").select(own["conv"], own["turn"], "own_text", F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "parent")
    told = written(told, "messages")
    placed = threads(told.groupBy("conv", "turn").agg(F.max("parent").alias("parent")))
    both = told.drop("parent").join(placed, told["conv"].eqNullSafe(placed["conv"]) & told["turn"].eqNullSafe(placed["turn"]))
    return both.select(
        told["conv"].alias(conv_col), told["turn"].alias(turn_col), F.col("parent").alias("parent_turn"), "thread", "depth", "n_quotes", "n_linked", "own_text")


def quoting(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, text)``: the turns of a conversation as mails. Each one quotes the turn before it,
    and on the second level the turn before that; it announces the quote. For tables without quotes."""
    quote = lambda mark, text: F.when(text != "", F.regexp_replace(F.concat(F.lit("\n"), text), "\n", "\n" + mark))
    turns = conversations.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    back = lambda n: turns.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("text").alias(f"back{n}"))
    mails = turns.join(back(1), ["conv_id", "turn"], "left").join(back(2), ["conv_id", "turn"], "left")
    heading = F.when((F.coalesce("back1", F.lit("")) != "") | (F.coalesce("back2", F.lit("")) != ""), F.concat(F.lit("\n\nOn turn "), F.col("turn").cast("string"), F.lit(" they wrote:")))
    text = F.concat(F.col("text"), F.coalesce(heading, F.lit("")), F.coalesce(quote("> ", F.col("back1")), F.lit("")), F.coalesce(quote("> > ", F.col("back2")), F.lit("")))
    return mails.select("conv_id", "turn", text.alias("text"))
