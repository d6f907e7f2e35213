"""Joins.  None is hinted: adaptive execution broadcasts a side only once its shuffled
size is known to be small, and splits skewed partitions of the other side otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.operators.rows import fill_const, quoted


def anti_join_droplist(df: DataFrame, drop_list: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not on the drop list (one ``key`` column)."""
    return df.join(drop_list.select(F.col("key").alias(key)), key, "left_anti")


def right_join_recovery(loans: DataFrame, recoveries: DataFrame, *by: str) -> DataFrame:
    """Loans with what was recovered on them (within the columns ``by``); 0 recovered where nothing was."""
    joined = loans.join(recoveries, ["loan_id", *by], "left")
    return joined.withColumn("recovered_amt", F.coalesce("recovered_amt", F.lit(0.0)))


def multi_owner_keys(distinct_pairs: DataFrame) -> DataFrame:
    """Keys that occur with more than one owner, from distinct (key, owner) rows."""
    return distinct_pairs.groupBy("key").count().where(F.col("count") > 1).select("key")


def inner_join_multi_owner(pairs: DataFrame) -> DataFrame:
    """Distinct (key, owner) rows of the keys with more than one owner."""
    distinct = pairs.distinct()
    return distinct.join(multi_owner_keys(distinct), "key", "left_semi")


def owner_semi_join(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """Distinct (key, owner) rows whose owner is among the owners given."""
    return pairs.distinct().join(owners.select("owner").distinct(), "owner", "left_semi").select("key", "owner")


def owner_anti_join(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """Distinct (key, owner) rows whose owner is not among the owners given."""
    return pairs.distinct().join(owners.select("owner").distinct(), "owner", "left_anti").select("key", "owner")


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def id_spine(tables: Sequence[tuple[DataFrame, str]], name: str = "bib_id") -> DataFrame:
    """Distinct keys of all tables; each table comes with the name of its own key."""
    return union_distinct([df.select(F.col(key).alias(name)) for df, key in tables])


def store_left_joins(spine: DataFrame, tables: Sequence[tuple[DataFrame, str]], name: str = "bib_id") -> DataFrame:
    """The spine with every table's columns; unmatched is NULL.

    All joins use one key, so the running result is shuffled and sorted once.
    """
    return reduce(lambda left, t: left.join(t[0].withColumnRenamed(t[1], name), name, "left"), tables, spine)


def store_coalesce(df: DataFrame, constants: Mapping[str, float], queries: Mapping[str, Column]) -> DataFrame:
    """Defaults, constants and scalar subqueries, for the NULLs a left join leaves."""
    filled = fill_const(df, constants)
    types = dict(df.dtypes)
    return filled.withColumns({
        name: F.coalesce(F.col(quoted(name)), scalar.cast(types[name])) for name, scalar in queries.items()
    })
