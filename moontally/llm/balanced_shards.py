"""Sharding by balanced label propagation: linked documents move together while shard sizes stay even.

Documents with an equal link key are linked. A document starts in the shard of its id's hash, so a key's documents form at
most one block per shard; blocks, which are counted before anything is shuffled, are what moves. In each
round blocks join the histogram of their key over shards and pick the shard with most of their key's
documents that is ahead of their own and has room for them. Moves into a shard are let in while their running sum
fits its quota, so no round fills a shard beyond it. A key that is larger than a quota ends up in as few shards as
have room. Blocks that find no room are exchanged: as many blocks of a size go from one shard to another as come back.

Rounds go on until no block moves. They end: every block moves to a shard that is ahead of its own by (documents of the
key, hash), so each round adds to the sum, over keys and shards, of the squared number of a key's documents in a shard.

At the end sizes are made exact: counts are at most one apart. In a shard that has too many, the documents last in
line (those without links first) go to the places left in others.

Only DataFrame functions are used. Ranks and running sums are taken in buckets, so no task holds a shard.

Defined cases: a null link key links with nothing. Rows with equal ids, also repeated rows, are documents of their own. An empty
table gives no rows. Columns of the input other than those named are not read, whatever their names.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running, stash

SHARDS = 8


def bucket_count(rows: int) -> int:
    """Buckets for ranks: many more than tasks while there are few rows, and of bounded size when there are many."""
    return max(1, min(-(-rows // 256), max(4096, -(-rows // 65536))))


def pick(values: list[int], at: Column) -> Column:
    return F.get(F.array(*(F.lit(x).cast("long") for x in values)), at)


def moved(blocks: DataFrame, room: list[int], turn: int) -> DataFrame:
    """Blocks (link, block) that move in one round, with their ``target``; moves fit the ``room`` of each shard."""
    seen = blocks.groupBy("link", "shard").agg(F.sum("n").alias("_there"))
    order = F.struct(F.col("_there"), F.xxhash64("link", "_to"))
    seen = seen.select("link", F.col("shard").alias("_to"), "_there").withColumn("_order", order)
    options = blocks.join(seen, "link").withColumn("_own", F.col("shard") == F.col("_to"))
    choice = F.struct("_order", "_to")
    best = options.groupBy("link", "block", "n", "shard").agg(
        F.max(F.when(F.col("_own"), F.col("_order"))).alias("_mine"),
        F.max(F.when(~F.col("_own") & (pick(room, F.col("_to")) >= F.col("n")), choice)).alias("_best"),
        F.max(F.when(~F.col("_own"), choice)).alias("_wish"),
    )
    fits = F.coalesce(F.col("_best._order") > F.col("_mine"), F.lit(False))
    movers = best.where(F.col("_wish._order") > F.col("_mine")).select(
        "link", "block", "n", "shard", fits.alias("_fits"), F.when(fits, F.col("_best._to")).otherwise(F.col("_wish._to")).alias("target")
    )
    movers = stash(movers)
    buckets = bucket_count(movers.count())
    movers = movers.withColumn("_bucket", F.pmod(F.xxhash64("link", "block", F.lit(turn)), F.lit(buckets)))
    entering = running(movers.where("_fits"), ["target"], "_bucket", mixed_order(), "_before", F.col("n"))
    entering = entering.where(F.col("_before") + F.col("n") <= pick(room, F.col("target")))
    return entering.select("link", "block", "target").unionByName(exchanged(movers.where("not _fits")))


def mixed_order() -> list[Column]:
    return [F.xxhash64("link", "block"), F.col("link"), F.col("block")]


def exchanged(movers: DataFrame) -> DataFrame:
    """Of the blocks that found no room, those that change places with as many of their size: no shard grows by them."""
    lane = ["shard", "target", "n"]
    parts = movers.groupBy(*lane, "_bucket").agg(F.count("*").alias("_count"))
    back = parts.groupBy(F.col("target").alias("shard"), F.col("shard").alias("target"), "n").agg(F.sum("_count").alias("_back"))
    # joined by part, so that the blocks between two shards do not meet in one task
    allowed = parts.join(back, lane).select(*lane, "_bucket", "_back")
    queue = running(movers, lane, "_bucket", mixed_order(), "_before").join(allowed, [*lane, "_bucket"])
    return queue.where(F.col("_before") < F.col("_back")).select("link", "block", "target")


def propagate(blocks: DataFrame, quotas: list[int]) -> DataFrame:
    """Blocks (link, block, n) with their ``shard``, once no block moves."""
    blocks = stash(blocks.withColumn("shard", F.col("block")))
    for turn in count():
        load = {row.shard: row.n for row in blocks.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row per shard
        room = [max(0, quota - load.get(shard, 0)) for shard, quota in enumerate(quotas)]
        moves = stash(moved(blocks, room, turn))
        if moves.isEmpty():
            return blocks
        joined = blocks.join(moves, ["link", "block"], "left")
        blocks = stash(joined.select("link", "block", "n", F.coalesce("target", "shard").alias("shard")))


def shard(docs: DataFrame, doc_id: str, link: str, shards: int = SHARDS, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, also..., linked, shard, slot) of every row: slots of a shard count from 0 without gaps.

    ``linked`` tells whether another row has the same link key.
    """
    ids = [F.col(doc_id).alias("doc_id"), *(F.col(c) for c in also), F.col(link).cast("string").alias("link")]
    rows = docs.select(*ids)
    single = F.concat_ws(":", F.lit("single"), F.monotonically_increasing_id())
    rows = rows.withColumn("link", F.when(F.col("link").isNull(), single).otherwise(F.concat(F.lit("link:"), "link")))
    rows = stash(rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")))
    total = rows.count()
    quotas = [total // shards + (i < total % shards) for i in range(shards)]

    blocks = rows.groupBy("link", "block").agg(F.count("*").alias("n"))
    blocks = blocks.withColumn("_all", F.sum("n").over(Window.partitionBy("link"))).where("_all > 1").drop("_all")
    placed = propagate(blocks, quotas).select("link", "block", "shard")
    labelled = rows.join(placed, ["link", "block"], "left").select(
        "doc_id", *also, "link", F.col("shard").isNotNull().alias("linked"), F.coalesce("shard", "block").alias("label")
    )

    buckets = bucket_count(total)
    mixed = F.pmod(F.xxhash64("doc_id", *also), F.lit(buckets))
    labelled = labelled.withColumn("_bucket", F.when(F.col("linked"), mixed).otherwise(mixed + buckets))
    order = [F.col("doc_id"), *(F.col(c) for c in also), F.col("link")]
    ranked = stash(running(stash(labelled), ["label"], "_bucket", order, "_rank"))
    counts = {row.label: row.n for row in ranked.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one row per shard
    out = ["doc_id", *also, "linked"]
    kept = ranked.where(F.col("_rank") < pick(quotas, F.col("label")))
    kept = kept.select(*out, F.col("label").alias("shard"), F.col("_rank").alias("slot"))
    over = ranked.where(F.col("_rank") >= pick(quotas, F.col("label"))).drop("_rank").withColumn("_every", F.lit(0))
    if not any(counts.get(i, 0) > quota for i, quota in enumerate(quotas)):
        return kept
    over = running(stash(over), ["_every"], "_bucket", order, "_rank")
    free = [max(0, quota - counts.get(i, 0)) for i, quota in enumerate(quotas)]
    before = [sum(free[:i]) for i in range(shards)]
    to = F.lit(0)
    for i in range(shards):
        if free[i]:
            to = F.when(F.col("_rank") >= before[i], i).otherwise(to)
    over = over.withColumn("shard", to)
    slot = F.col("_rank") - pick(before, F.col("shard")) + pick([counts.get(i, 0) for i in range(shards)], F.col("shard"))
    return kept.unionByName(over.select(*out, "shard", slot.alias("slot")))
