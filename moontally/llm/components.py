"""Connected components of links, by alternating large-star and small-star rounds.

Each round is joins and groupings of the links; nothing is gathered. Every round's links are
written to the shared folder, so a round that is run again starts from files. A node with very many
links meets them in a join that Spark can split, and minima are taken before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(links: DataFrame, one: str, other: str) -> DataFrame:
    """(node, root) of every node with a link to another node; root is the least node reachable.

    Links may repeat, in either direction; links of a node to itself and links with a null are ignored.
    """
    a, b = F.col(one), F.col(other)
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stash(edges)
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = stash(small.where(F.col("u") != F.col("v")).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
