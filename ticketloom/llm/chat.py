"""Quotation linking: replies joined to the messages they quote. DataFrame functions only.

Lines that begin with `>` are quoted, one level per `>`. Quoted passages and the parts of
every message's own text are normalised and hashed; a passage belongs to the earliest
message of its conversation that wrote the longest part of it found. Messages that quote
become replies, and chains of replies become threads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketloom.llm.storage import stored

QUOTE = "^(?:[ \\t]*>)+"


def normalised(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), "[ \\t\\r\\f]+", " "))


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), "[^>]", ""))


def own_text(text: Column) -> Column:
    """The lines of a message that quote nothing."""
    own = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: ~line.rlike(QUOTE))
    return F.array_join(own, "\n")


def passages(text: Column) -> Column:
    """Quoted passages as (level, lines): neighbouring lines of one level, normalised.

    Blank quoted lines part nothing and are left out, so a passage that was wrapped
    anew still has the same words in order.
    """
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.struct(
            quote_level(line).alias("level"), normalised(F.regexp_replace(line, QUOTE, "")).alias("line")
        ),
    )
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    level = lambda i: F.get(lines, i).getField("level")
    starts = F.filter(places, lambda i: (i == 0) | (level(i) != level(i - 1)))
    runs = F.transform(
        starts,
        lambda start, nth: F.struct(
            level(start).alias("level"),
            F.filter(
                F.slice(lines, start + 1, F.coalesce(F.get(starts, nth + 1), F.size(lines)) - start).getField("line"),
                lambda line: line != "",
            ).alias("lines"),
        ),
    )
    return F.filter(runs, lambda run: (run["level"] > 0) & (F.size(run["lines"]) > 0))


def original_units(text: Column) -> Column:
    """What of a message's own text can be found again: all of it, paragraphs and lines."""
    lines = F.transform(F.split(own_text(text), "\n"), normalised)
    solid = F.filter(lines, lambda line: line != "")
    joined = F.regexp_replace(F.array_join(lines, "\n"), "\n\n+", "\n\n")
    paragraphs = F.transform(F.split(joined, "\n\n"), lambda p: F.trim(F.regexp_replace(p, "\n", " ")))
    units = F.concat(F.array(F.array_join(solid, " ")), paragraphs, solid)
    return F.array_distinct(F.filter(units, lambda unit: unit != ""))


def link_quotations(
    messages: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """One row per message, with its reply text and its place in a thread.

    Columns: conv_id, turn, role, reply_text (own lines, trimmed), quoted_passages,
    linked_passages, reply_to (turn quoted from), thread_turn (turn of the thread's first
    message) and depth (replies between). Sorted by (conv_id, thread_turn, turn), every
    message follows the one it replies to.

    A passage is linked to a message of the same conversation and an earlier turn; among
    its parts found (whole passage, single lines) the longest decides, then the later
    turn. The reply is to the link of lowest quote level, then of the latest turn.
    Messages without links begin a thread of their own. Null and empty texts quote
    nothing; rows with a null conversation or turn are never linked. Rows that repeat a
    conversation and turn share the latest of their replies; identical rows stay repeated.
    """
    rows = messages.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    quotes = F.col("text").rlike("(?m)" + QUOTE)
    quoting = rows.where(quotes).select("conv_id", "turn", "text").distinct()
    quoting = quoting.select(
        "conv_id", "turn", F.md5("text").alias("message"), F.posexplode(passages(F.col("text"))).alias("passage", "run")
    )
    lines = F.col("run.lines")
    units = F.array_distinct(F.concat(F.array(F.array_join(lines, " ")), lines))
    asked = quoting.select(
        "conv_id", "turn", "message", "passage", F.col("run.level").alias("level"), F.explode(units).alias("unit")
    )
    asked = stored(asked.withColumn("hash", F.md5("unit")), "quoted")
    written = rows.where("conv_id is not null and turn is not null").select(
        "conv_id", "turn", F.explode(original_units(F.col("text"))).alias("unit")
    )
    written = written.groupBy("conv_id", F.md5("unit").alias("hash")).agg(F.min("turn").alias("original"))
    # One row per hash on either side; then the many that quote the same find it in a table.
    answers = stored(asked.select("conv_id", "hash").distinct().join(written, ["conv_id", "hash"]), "answers")
    links = (
        asked.join(answers, ["conv_id", "hash"])
        .where("original < turn")
        .groupBy("conv_id", "turn", "message", "passage", "level")
        .agg(F.max(F.struct(F.length("unit"), "original")).getField("original").alias("original"))
    )
    links = stored(links, "links")
    per_message = links.groupBy("conv_id", "turn", "message").agg(F.count("*").alias("linked_passages"))
    latest = F.max(F.struct((-F.col("level")).alias("near"), "original")).getField("original")
    replies = links.groupBy("conv_id", "turn").agg(latest.alias("reply_to"))
    threads = thread_roots(replies)
    keyed = rows.withColumn("message", F.md5(F.coalesce("text", F.lit(""))))
    return (
        keyed.join(stored(per_message, "counts"), ["conv_id", "turn", "message"], "left")
        .join(threads, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            F.trim(own_text(F.col("text"))).alias("reply_text"),
            F.when(quotes, F.size(passages(F.col("text")))).otherwise(0).cast("long").alias("quoted_passages"),
            F.coalesce("linked_passages", F.lit(0)).cast("long").alias("linked_passages"),
            "reply_to",
            F.coalesce("thread_turn", "turn").alias("thread_turn"),
            F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        )
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """Conversations without quotes: linked messages with their place, from 1, in their conversation.

    Threads follow each other by their first message, messages within a thread by turn, so
    each comes after the one it replies to. Rows of one turn stand by role, then by
    reply text, nulls first; identical rows get neighbouring places. Messages without a conversation are
    numbered as one, those without a turn come first in theirs. No rows give no rows. Other columns are kept.

    Rows are range-partitioned by place, so a long conversation spans many tasks; each
    numbers its own part, and the parts' sizes, a row per conversation and part, are
    summed up to the rows before.
    """
    keys = ["conv_id", "thread_turn", "turn", "role", "reply_text"]
    part, row = (_new_name(linked, name) for name in ("part", "row"))
    parted = linked.repartitionByRange(*keys).withColumn(part, F.spark_partition_id())
    parted = stored(parted, "reply-order")
    own = Window.partitionBy("conv_id", part).orderBy(*keys[1:])
    earlier = Window.partitionBy("conv_id").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy("conv_id", part).agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.select(
        F.col("conv_id").alias("_conv"), F.col(part).alias("_part"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    numbered = parted.withColumn(row, F.row_number().over(own).cast("long")).alias("m")
    same = F.col("m.conv_id").eqNullSafe(F.col("s._conv")) & (F.col(f"m.{part}") == F.col("s._part"))
    place = (F.col("s.before") + F.col(f"m.{row}")).alias("place")
    return numbered.join(sizes.alias("s"), same).select(*[F.col(f"m.`{c}`") for c in linked.columns if c != "place"], place)


def _new_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def thread_roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread_turn, depth) of every reply.

    Each round doubles the way looked back, so the rounds grow with the logarithm of the
    longest chain. Chains end because a reply's turn is later than its original's.
    """
    ways = replies.select(
        "conv_id", "turn", "reply_to", F.col("reply_to").alias("thread_turn"), F.lit(1).cast("long").alias("depth")
    )
    ways = stored(ways, "ways")
    while True:
        back = ways.select("conv_id", F.col("turn").alias("thread_turn"), F.col("thread_turn").alias("farther"), F.col("depth").alias("more"))
        ways = ways.join(back, ["conv_id", "thread_turn"], "left").select(
            "conv_id",
            "turn",
            "reply_to",
            F.coalesce("farther", "thread_turn").alias("thread_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("farther").isNotNull().alias("moved"),
        )
        ways = stored(ways, "ways")
        if ways.where("moved").isEmpty():
            return ways.drop("moved")
        ways = ways.drop("moved")
