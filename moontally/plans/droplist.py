"""Drop list: subscribers that changed owner between two months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.operators.rows import notnull_key_filter

KEYS = ("fake_msisdn", "bib_id")
OWNERS = ("fake_ic_number", "nid_hash")


def ownership(current: DataFrame, previous: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, owner) rows of both months, from the first key and owner name both have."""
    key, owner = (_shared(names, current, previous) for names in (KEYS, OWNERS))

    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.col(owner).alias("owner"))

    return pairs(current), pairs(previous)


def _shared(names: tuple[str, ...], *frames: DataFrame) -> str:
    for name in names:
        if all(name in df.columns for df in frames):
            return name
    raise ValueError(f"none of {names} is in both months")


def owner_changes(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Every distinct (key, owner) row of the previous month, with what became of its key and owner.

    ``shared_before``: its key had another owner, too.  ``owner_now``: its owner is there in the current
    month; ``owner_shares``: there on a key with another owner.  Both months go through one stack: rows are
    made distinct once, and flags of keys and owners are merged by every task before they are shuffled.  The
    rows of a hot key or owner meet its one row of flags in a join, which adaptive execution splits.
    """
    stacked = tagged(current, now=True).unionByName(tagged(previous, now=False))
    pairs = stacked.groupBy("key", "owner").agg(F.max("now").alias("now"), F.max("before").alias("before"))
    owners_of_key = pairs.groupBy("key").agg(
        (F.count_if("now") > 1).alias("shared_now"), (F.count_if("before") > 1).alias("shared_before")
    )
    shared = owners_of_key.where(F.col("shared_now") | F.col("shared_before"))
    marked = pairs.join(shared, "key", "left")
    present = marked.where("now").groupBy("owner").agg(F.max(F.coalesce("shared_now", F.lit(False))).alias("owner_shares"))
    met = marked.where("before").join(present, "owner", "left")
    return met.select(
        "key", "owner",
        F.coalesce("shared_before", F.lit(False)).alias("shared_before"),
        F.col("owner_shares").isNotNull().alias("owner_now"),
        F.coalesce("owner_shares", F.lit(False)).alias("owner_shares"),
    )


def tagged(pairs: DataFrame, now: bool) -> DataFrame:
    """Known (key, owner) rows with the month they come from."""
    return notnull_key_filter(pairs, "key", "owner").select("key", "owner", F.lit(now).alias("now"), F.lit(not now).alias("before"))


def changed_now(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Previous rows of owners that share a key with another owner in the current month."""
    return owner_changes(current, previous).where("owner_shares").select("key", "owner")


def changed_before(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Previous rows of shared keys whose owner is gone in the current month."""
    return owner_changes(current, previous).where("shared_before AND NOT owner_now").select("key", "owner")


def drop_list(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Distinct (key, owner) rows to drop; both inputs hold ``key`` and ``owner``."""
    return owner_changes(current, previous).where("owner_shares OR shared_before AND NOT owner_now").select("key", "owner")
