"""Row-level flags, buckets, text parsing and null-safe arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bank vocabulary, in matching order.
BANKS = (
    "mellat", "tejarat", "keshavarzi", "refah", "melli",
    "pasargad", "maskan", "resalat", "ayandeh", "parsian",
    "enbank", "sina", "iz",
)

# The handset brand vocabulary, in vector order.
HANDSET_BRANDS = ("SAMSUNG", "XIAOMI", "HUAWEI", "APPLE", "Other")

# Fixed value: a sender name starting like this, blanks aside, is a person and no bank.
PERSON_NAME = r"^[\x00-\x20]*v\."


def ratio(top: Column, bottom: Column) -> Column:
    """Division where a zero or NULL denominator gives NULL."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def is_weekend(day: Column) -> Column:
    """Thursday and Friday."""
    return F.dayofweek(day).isin(5, 6)


def is_afternoon(moment: Column, amount: Column) -> Column:
    """After 15:59, on rows that moved money."""
    return (amount > 0) & (F.hour(moment) > 15)


def travel_bucket(total: Column) -> Column:
    """1-5, 6-10 or 11+; an unknown total counts as 11+."""
    return F.when(total <= 5, "1-5").when(total <= 10, "6-10").otherwise("11+")


def strip_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def norm_string(text: Column) -> Column:
    """Spaces removed, lower case."""
    return F.lower(strip_spaces(text))


def data_mb(name: Column) -> Column:
    """Data volume in MB written in an offer name.

    A name with the unit but no number before it gives NULL, a name without a unit 0.
    """
    text = norm_string(name)

    def amount(unit: str) -> Column:
        return F.regexp_extract(text, rf"(\d+(?:\.\d+)?)\s*{unit}", 1).try_cast("double")

    return (
        F.when(F.contains(text, F.lit("gb")), amount("gb") * 1024)
        .when(F.contains(text, F.lit("mb")), amount("mb"))
        .otherwise(F.lit(0.0))
    )


def clean_name(name: Column) -> Column:
    """Lower case, nothing but letters, digits and blanks; NULL for persons."""
    lowered = F.lower(name)
    return F.when(~lowered.rlike(PERSON_NAME), F.regexp_replace(lowered, r"[^a-z0-9\s]", ""))


def vocab_match(name: Column, vocabulary: Sequence[str] = BANKS) -> Column:
    """Vocabulary words contained in a sender name, in vocabulary order."""
    cleaned = F.coalesce(clean_name(name), F.lit(""))
    return F.filter(F.array(*[F.lit(word) for word in vocabulary]), lambda word: F.contains(cleaned, word))


def has_vocab(name: Column, vocabulary: Sequence[str] = BANKS) -> Column:
    """Whether a sender name holds any vocabulary word: one pattern, cheap enough for a filter."""
    return clean_name(name).rlike("|".join(vocabulary))


def vocab_position(cleaned: Column, vocabulary: Sequence[str] = BANKS) -> Column:
    """Position of the first vocabulary word in a cleaned name, NULL without one."""
    return F.coalesce(*[F.when(F.contains(cleaned, F.lit(word)), F.lit(i)) for i, word in enumerate(vocabulary)])


def one_hot_vocab(word: Column, vocabulary: Sequence[str] = HANDSET_BRANDS) -> list[Column]:
    """One 0/1 column per vocabulary entry; unknown words count nowhere."""
    return [flag(word == entry) for entry in vocabulary]


def days_after_due(day: Column, due: Column) -> Column:
    return F.datediff(day, due)


def days_delay(day: Column, due: Column, delayed: Column) -> Column:
    """Recorded delay, or the age of the due date while nothing is recorded."""
    return F.coalesce(delayed, F.datediff(day, due))


def debt_status(after_due: Column, delay: Column, delayed: Column, max_age: int) -> Column:
    """Instalment class: 4 paid late, 3 paid on time, 2 unpaid late, 1 not due, -1 older."""
    late, paid = delay > 0, delay == delayed
    unpaid = delayed.isNull()
    young = after_due <= max_age
    return (
        F.when(young & late & paid, 4)
        .when(young & late & unpaid, 2)
        .when(young & ~late & paid, 3)
        .when(young & ~late & unpaid, 1)
        .otherwise(-1)
    )


def terrible_debt_status(after_due: Column, delayed: Column) -> Column:
    """Instalments 60 or more days old: 1 unpaid, 2 paid within 31 days of now, -1 else."""
    old = after_due >= 60
    return F.when(old & delayed.isNull(), 1).when(old & (after_due - delayed <= 31), 2).otherwise(-1)
