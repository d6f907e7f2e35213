"""Chat formatting by quotation linking: nested quotes are parsed, linked to what they quote, and taken out.

A line's quote level is the number of > marks it starts with. Neighbouring lines of one level form a passage. A passage, a
message's body (its lines of level 0), and the paragraphs, lines and sentences of both are normalised (lower case, white space
collapsed) and hashed. Within a conversation a passage links to its original: the earliest message that holds it, or else the longest of
its parts that any holds (of equal lengths the latest message), unquoted, if that is before the quoting one. A message replies to the original of its passage of the
lowest level; of several, to the latest. Following replies leads to the root of a thread. Conversations are ordered by thread
(the turn of its root), then by turn, so a reply comes after what it answers.

Only DataFrame functions are used. Originals are minima per hash, taken before the shuffle, so a passage that a third of all
messages hold is one row. Places in a conversation are ranks over a range-partitioned table: a
conversation of any size is spread over tasks.

Defined cases: a null text has no quotes, a null body and no links; an empty one an empty body. A null conversation
is a conversation of its own; a null turn comes first and is never quoted. Rows with equal conversation and turn are one message in several rows:
each gets a place, and they share their reply link. Columns of the input other than those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, running, stash

QUOTED = r"(?m)^[ \t]*>"
_PREFIX = r"^[ \t]*(?:>[ \t]*)+"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def body(text: Column) -> Column:
    """The text without quoted lines; a text without quotes as it is."""
    own = F.filter(F.split(text, "\n"), lambda line: ~line.rlike(r"^[ \t]*>"))
    return F.when(text.rlike(QUOTED), F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")).otherwise(text)


def parts(text: Column) -> Column:
    """The normalised forms of a text: as a whole, its paragraphs, lines, and the sentences of these."""
    blocks = F.concat(F.array(text), F.split(text, r"\n[ \t]*\n"), F.split(text, "\n"))
    blocks = F.array_distinct(F.transform(blocks, normal))
    sentences = F.flatten(F.transform(blocks, lambda x: F.split(x, r"(?<=[.!?]) |(?<=[。！？]) ?")))
    return F.filter(F.array_distinct(F.concat(blocks, sentences)), lambda x: x != "")


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, passage, length, hash) of the parts of the quoted passages of messages (conv, turn, text)."""
    quoted = messages.where(F.col("text").rlike(QUOTED)).dropDuplicates(["conv", "turn", "text"])
    quoted = quoted.withColumn("_id", F.md5("text"))
    lines = quoted.select("conv", "turn", "_id", F.posexplode(F.split("text", "\n")).alias("_i", "_line"))
    prefix = F.regexp_extract("_line", _PREFIX, 0)
    lines = lines.withColumn("level", F.length(F.regexp_replace(prefix, "[^>]", ""))).withColumn("_line", F.regexp_replace("_line", _PREFIX, ""))
    inside = Window.partitionBy("conv", "turn", "_id", "level").orderBy("_i")
    lines = lines.withColumn("_run", F.col("_i") - F.row_number().over(inside)).where("level > 0")
    found = lines.groupBy("conv", "turn", "_id", "level", "_run").agg(F.sort_array(F.collect_list(F.struct("_i", "_line"))).alias("_lines"))
    text = F.array_join(F.transform("_lines", lambda x: x["_line"]), "\n")
    found = found.select("conv", "turn", "level", F.struct("_id", "_run").alias("passage"), F.explode(parts(text)).alias("_text"))
    return found.select("conv", "turn", "level", "passage", F.length("_text").alias("length"), F.md5("_text").alias("hash"))


def quoting(messages: DataFrame) -> DataFrame:
    """Messages of the conversations in which any line is quoted; the others have nothing to link.

    Conversations are told apart by 64-bit hashes, which bounds the size of the set; one that shares a hash is only read in vain.
    """
    key = F.xxhash64("conv")
    found = stash(messages.where(F.col("text").rlike(QUOTED)).select(key.alias("_conv")).distinct())
    return messages.withColumn("_conv", key).join(broadcast_if_small(found, 64), "_conv", "left_semi").drop("_conv")


def originals(messages: DataFrame) -> DataFrame:
    """(conv, hash, original): the earliest turn whose body holds a text as a whole, as a paragraph, a line or a sentence."""
    keys = F.transform(parts(body(F.col("text"))), F.md5)
    rows = messages.where("text is not null and turn is not null").select("conv", "turn", F.explode(keys).alias("hash"))
    return rows.groupBy("conv", "hash").agg(F.min("turn").alias("original"))


def replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent) of the messages that quote an earlier one of their conversation."""
    met = passages(messages).join(originals(quoting(messages)), ["conv", "hash"]).where("original < turn")
    met = met.groupBy("conv", "turn", "level", "passage").agg(F.max(F.struct("length", "original")).alias("_longest"))
    met = met.select("conv", "turn", "level", F.col("_longest.original").alias("original"))
    nearest = met.groupBy("conv", "turn").agg(F.max(F.struct((-F.col("level")).alias("level"), "original")).alias("_best"))
    return nearest.select("conv", "turn", F.col("_best.original").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """(conv, turn, parent, root, depth) of replies; pointers double until all end at a message that replies to none."""
    table = stash(links.withColumn("root", F.col("parent")).withColumn("depth", F.lit(1).cast("long")))
    while True:
        ahead = table.select("conv", F.col("turn").alias("root"), F.col("root").alias("_next"), F.col("depth").alias("_more"))
        joined = table.join(ahead, ["conv", "root"], "left")
        if joined.where("_next is not null").isEmpty():
            return table
        table = stash(joined.select(
            "conv", "turn", "parent", F.coalesce("_next", "root").alias("root"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")
        ))


def conversations(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, position, parent, root, depth, body, formatted) of every row, without quotes.

    ``position`` counts from 0 in each conversation's reply order; ``parent`` is null and ``root`` the own turn for a message
    that replies to none; ``formatted`` puts the role's marker before the body.
    """
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    keyed = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"), "turn", "text")
    known = roots(replies(keyed))
    rows = rows.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    rows = rows.join(known, ["conv", "turn"], "left").withColumn("root", F.coalesce("root", "turn"))
    rows = rows.withColumn("body", body(F.col("text"))).withColumn("_tie", F.md5(F.coalesce("text", F.lit("")))).drop("text")
    order = ["conv", "root", "turn", "role", "_tie"]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order, "_row")
    dealt = stash(dealt.withColumn("_part", F.spark_partition_id().cast("long")))
    placed = running(dealt, ["conv"], "_part", [F.col(c) for c in [*order[1:], "_row"]], "position")
    marker = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("body", F.lit("")))
    return placed.select(
        "conv_id", "turn", "role", "position", "parent", "root", F.coalesce("depth", F.lit(0)).alias("depth"), "body", marker.alias("formatted")
    )
