"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times its documents are to appear: target weight times target size, over its own size. A
document's number of copies inverts the Poisson distribution with that mean at a number in [0, 1) hashed from the seed
and its id: the least k whose cumulative probability exceeds it. Each document is exploded by its number
and all copies are shuffled by a hash, so any run of the output is a fair draw of the mixture.

Only DataFrame functions are used. Sizes are counted over all rows, with partial sums before the shuffle. The
rates are broadcast if their measured size allows and are joined otherwise.

Defined cases: a null source is a source of its own. A null id hashes as the word null; rows with equal ids get
equal numbers of copies. Texts are not looked at. Weights of sources that do not occur are ignored; a source without a
weight gets none and is left out when weights are given. An empty table gives no rows. All columns of the
input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, stash, unit_hash

#: Without given weights a source's weight is its share of the documents to this power.
POWER = 0.5
SEED = 17


def poisson_table(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, 2, ... until what is left cannot be told from nothing."""
    places = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int"))
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate / k)
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.array_append(state["all"], total).alias("all"))

    return F.aggregate(places, start, step)["all"]


def key(source: Column) -> Column:
    """A join key that is never null."""
    return F.when(source.isNull(), "null").otherwise(F.concat(F.lit("source:"), source.cast("string")))


def rates(docs: DataFrame, source: str, weights: dict[str, float] | None = None, power: float = POWER, size: int | None = None) -> DataFrame:
    """(key, n, rate) of every source with a weight; ``size`` is the number of copies aimed at, by default that of the documents."""
    counts = stash(docs.groupBy(key(F.col(source)).alias("key")).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n") / F.lit(float(max(total, 1))), F.lit(power)))
    else:
        spark = docs.sparkSession
        given = spark.createDataFrame([(f"source:{s}", float(w)) for s, w in weights.items()], "key string, weight double")
        weighted = counts.join(given.where("weight > 0"), "key")
    whole = weighted.agg(F.sum("weight")).first()[0] or 1.0
    return weighted.select("key", "n", (F.lit(float(size or total)) * F.col("weight") / F.lit(whole) / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame, doc_id: str, source: str, *, weights: dict[str, float] | None = None, power: float = POWER,
    size: int | None = None, seed: int = SEED, copy: str | None = "copy",
) -> DataFrame:
    """The rows of ``docs`` by their number of copies, in shuffled order, with the copy's number from 0.

    The number's column is ``copy``, with underscores added while the input has a column of that name; None leaves it out.
    """
    columns = docs.columns
    while copy in columns:
        copy += "_"
    table = stash(rates(docs, source, weights, power, size).select("key", poisson_table(F.col("rate")).alias("_table")))
    held = table.agg(F.sum(F.size("_table") * 8 + F.octet_length("key") + 64)).first()[0] or 0
    table = F.broadcast(table) if held <= BROADCAST_BYTES else table
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"), key(F.col(source)).alias("key"), F.col(doc_id).alias("_id"))
    rows = rows.join(table, "key").withColumn("_u", unit_hash(F.lit(seed), F.col("_id")))
    times = F.size(F.filter("_table", lambda c: c <= F.col("_u")))
    rows = rows.select("_row", "_id", times.alias("_n")).where("_n > 0")
    rows = rows.select("_row", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_copy"), "_id")
    rows = rows.withColumn("_at", F.xxhash64(F.lit(seed), "_id", "_copy"))
    rows = rows.repartition("_at").sortWithinPartitions("_at")
    number = [F.col("_copy").alias(copy)] if copy else []
    return rows.select(*(F.col("_row")[c].alias(c) for c in columns), *number)
